"""The queries of the catalog in plain SQL (DuckDB), over the same test tables.

Written as independent formulations: grouped statements with FILTER, global window
functions and exact quantile functions, none of which the Spark operators use.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from arrears.operators import early_warning, policy, quality, store
from arrears.plans.catalog import (
    AS_OF_MONTHS,
    COEFS,
    CUTS,
    DIGITS,
    DIGITS_OF,
    EXPECTED_ROWS,
    FINE_CUTS,
    HISTOGRAM_FEATURES,
    INTERCEPT,
    SAMPLE,
)

RAW = """
app AS (
  SELECT c_custkey AS SK_ID_CURR,
         CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS TARGET,
         CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE 10000 + 10 * abs(c_acctbal) END AS AMT_CREDIT,
         c_mktsegment AS NAME_CONTRACT_TYPE
  FROM customer),
ins0 AS (
  SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV, l_linenumber AS NUM_INSTALMENT_NUMBER,
         CAST(date_diff('day', DATE '2001-03-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS due,
         l_quantity, l_linenumber, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ins AS (
  SELECT SK_ID_CURR, SK_ID_PREV, NUM_INSTALMENT_NUMBER, due AS DAYS_INSTALMENT,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
              ELSE due + CAST(l_quantity AS INT) - 20 END AS DAYS_ENTRY_PAYMENT,
         CASE WHEN l_linenumber = 7 THEN 0e0 ELSE l_extendedprice END AS AMT_INSTALMENT,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 0e0
              WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
              ELSE l_extendedprice * (1 - l_discount) * (1 + l_tax) END AS AMT_PAYMENT
  FROM ins0),
cc AS (
  SELECT user_id AS SK_ID_CURR,
         CAST(date_diff('day', DATE '2024-01-30', CAST(ts AS DATE)) AS INT) AS MONTHS_BALANCE,
         sum(value) AS AMT_BALANCE,
         CASE WHEN user_id % 11 = 0 THEN 0e0 ELSE 200e0 + 100 * (user_id % 5) END AS AMT_CREDIT_LIMIT_ACTUAL,
         sum(CASE WHEN event_type = 'purchase' THEN value END) AS AMT_PAYMENT_CURRENT,
         sum(CASE WHEN event_type = 'view' THEN value / 10 ELSE 0 END) AS AMT_INST_MIN_REGULARITY,
         sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS AMT_DRAWINGS_CURRENT,
         CAST(count(CASE WHEN event_type = 'error' THEN 1 END) AS INT) AS SK_DPD
  FROM events GROUP BY 1, 2),
bur AS (
  SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
         CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END AS CREDIT_ACTIVE,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey % 30 ELSE 0 END AS CREDIT_DAY_OVERDUE,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 0.1e0 ELSE 0e0 END AS AMT_CREDIT_SUM_OVERDUE,
         o_totalprice AS AMT_CREDIT_SUM,
         CASE WHEN o_orderstatus = 'F' THEN 0e0 WHEN o_orderstatus = 'P' THEN NULL
              ELSE o_totalprice * 0.4e0 END AS AMT_CREDIT_SUM_DEBT,
         CAST(date_diff('day', DATE '2001-12-01', CAST(o_orderdate AS DATE)) AS INT) AS DAYS_CREDIT
  FROM orders),
bb AS (
  SELECT l_orderkey AS SK_ID_BUREAU,
         CAST((year(l_shipdate) - 2001) * 12 + month(l_shipdate) - 11 AS INT) AS MONTHS_BALANCE,
         CASE WHEN l_returnflag = 'R' THEN CAST(1 + l_linenumber % 5 AS VARCHAR)
              WHEN l_returnflag = 'A' THEN '0'
              WHEN l_linestatus = 'O' THEN 'X' ELSE 'C' END AS STATUS
  FROM lineitem)"""


def slope(y: str, x: str) -> str:
    return f"CASE WHEN isnan(regr_slope({y}, {x})) THEN NULL ELSE regr_slope({y}, {x}) END"


def families(as_of: int = 0) -> str:
    """The feature families and the store as seen ``as_of`` months back."""
    days = 30 * as_of
    hidden = f"DAYS_ENTRY_PAYMENT + {days} > 0" if as_of else "FALSE"
    opened = f"DAYS_CREDIT <= {-days}" if as_of else "TRUE"

    def today(value: str, kind: str) -> str:
        """Accounts carry today's state only, which an earlier month does not know."""
        return f"CAST(NULL AS {kind})" if as_of else value

    features = ", ".join(
        store.INSTALLMENT_COLUMNS + store.CARD_COLUMNS + store.BUREAU_COLUMNS
    )
    return f"""
ins_seen AS (
  SELECT SK_ID_CURR, SK_ID_PREV, NUM_INSTALMENT_NUMBER, AMT_INSTALMENT,
         DAYS_INSTALMENT + {days} AS DAYS_INSTALMENT,
         CASE WHEN {hidden} THEN NULL ELSE DAYS_ENTRY_PAYMENT + {days} END AS paid_on,
         CASE WHEN {hidden} THEN NULL ELSE AMT_PAYMENT END AS paid
  FROM ins),
ins_base AS (
  SELECT SK_ID_CURR, SK_ID_PREV, NUM_INSTALMENT_NUMBER, DAYS_INSTALMENT,
         paid_on - DAYS_INSTALMENT AS days_late,
         CASE WHEN AMT_INSTALMENT = 0 OR paid IS NULL OR paid > AMT_INSTALMENT THEN 0e0
              ELSE 1 - paid / AMT_INSTALMENT END AS underpay_ratio,
         CASE WHEN paid = 0 THEN 1 ELSE 0 END AS is_missed
  FROM ins_seen WHERE DAYS_INSTALMENT <= 0 AND AMT_INSTALMENT >= 0),
ins_f AS (
  SELECT *, coalesce(ins_days_late_l3m, 0) - coalesce(ins_days_late_l6m, 0) AS ins_late_momentum
  FROM (
    SELECT SK_ID_CURR,
           avg(days_late) AS ins_days_late_mean, max(days_late) AS ins_days_late_max,
           avg(underpay_ratio) AS ins_underpay_ratio_mean, avg(is_missed) AS ins_pct_missed,
           count(*) FILTER (days_late > 0) / count(*) AS ins_pct_late,
           count(*) AS ins_total_obs,
           {slope("days_late", "DAYS_INSTALMENT")} AS ins_late_trend,
           avg(days_late) FILTER (DAYS_INSTALMENT >= -91) AS ins_days_late_l3m,
           avg(underpay_ratio) FILTER (DAYS_INSTALMENT >= -91) AS ins_underpay_ratio_l3m,
           CAST(sum(is_missed) FILTER (DAYS_INSTALMENT >= -91) AS BIGINT) AS ins_missed_count_l3m,
           nullif(count(*) FILTER (DAYS_INSTALMENT >= -91), 0) AS ins_obs_l3m,
           avg(days_late) FILTER (DAYS_INSTALMENT >= -182) AS ins_days_late_l6m,
           avg(underpay_ratio) FILTER (DAYS_INSTALMENT >= -182) AS ins_underpay_ratio_l6m,
           nullif(count(*) FILTER (DAYS_INSTALMENT >= -182), 0) AS ins_obs_l6m
    FROM ins_base GROUP BY SK_ID_CURR)),
cc_base AS (
  SELECT SK_ID_CURR, MONTHS_BALANCE + {as_of} AS MONTHS_BALANCE, AMT_BALANCE, AMT_DRAWINGS_CURRENT, SK_DPD,
         CASE WHEN AMT_CREDIT_LIMIT_ACTUAL > 0 THEN AMT_BALANCE / AMT_CREDIT_LIMIT_ACTUAL END AS utilization,
         CASE WHEN AMT_INST_MIN_REGULARITY > 0
              THEN AMT_PAYMENT_CURRENT / AMT_INST_MIN_REGULARITY END AS min_pay_ratio
  FROM cc WHERE MONTHS_BALANCE + {as_of} < 0),
cc_f AS (
  SELECT SK_ID_CURR,
         avg(utilization) AS cc_util_mean, max(utilization) AS cc_util_max,
         avg(AMT_BALANCE) AS cc_balance_mean, max(SK_DPD) AS cc_dpd_max, avg(SK_DPD) AS cc_dpd_mean,
         avg(min_pay_ratio) AS cc_min_pay_ratio_mean,
         {slope("utilization", "MONTHS_BALANCE")} AS cc_util_trend,
         {slope("AMT_BALANCE", "MONTHS_BALANCE")} AS cc_balance_trend,
         {slope("AMT_DRAWINGS_CURRENT", "MONTHS_BALANCE")} AS cc_drawings_trend,
         count(*) AS cc_total_obs,
         avg(utilization) FILTER (MONTHS_BALANCE >= -3) AS cc_util_l3m,
         avg(AMT_BALANCE) FILTER (MONTHS_BALANCE >= -3) AS cc_balance_l3m,
         avg(SK_DPD) FILTER (MONTHS_BALANCE >= -3) AS cc_dpd_l3m,
         avg(min_pay_ratio) FILTER (MONTHS_BALANCE >= -3) AS cc_min_pay_ratio_l3m,
         nullif(count(*) FILTER (MONTHS_BALANCE >= -3), 0) AS cc_obs_l3m
  FROM cc_base GROUP BY SK_ID_CURR),
bur_months AS (
  SELECT SK_ID_BUREAU, SK_ID_CURR, MONTHS_BALANCE + {as_of} AS MONTHS_BALANCE, STATUS,
         CASE WHEN STATUS = 'C' THEN 0 ELSE try_cast(STATUS AS INT) END AS dpd_bucket
  FROM bb JOIN bur USING (SK_ID_BUREAU) WHERE MONTHS_BALANCE + {as_of} < 0),
bur_status AS (
  SELECT SK_ID_CURR,
         count(*) FILTER (dpd_bucket >= 1) / count(*) AS bur_delinq_rate,
         avg(CASE WHEN dpd_bucket >= 1 THEN 1e0 WHEN dpd_bucket = 0 THEN 0e0 END)
           FILTER (MONTHS_BALANCE >= -12) AS bur_delinq_rate_12m,
         max(dpd_bucket) AS bur_worst_status_ever,
         {slope("dpd_bucket", "MONTHS_BALANCE")} AS bur_status_trend
  FROM bur_months GROUP BY SK_ID_CURR),
bur_acc AS (
  SELECT SK_ID_CURR, count(*) AS bur_total_accounts,
         {today("count(*) FILTER (CREDIT_ACTIVE = 'Active')", "BIGINT")} AS bur_active_accounts,
         {today("avg(CREDIT_DAY_OVERDUE)", "DOUBLE")} AS bur_days_overdue_mean,
         {today("max(CREDIT_DAY_OVERDUE)", "INT")} AS bur_days_overdue_max,
         {today("sum(AMT_CREDIT_SUM_OVERDUE)", "DOUBLE")} AS bur_amt_overdue_sum,
         {today("CASE WHEN sum(AMT_CREDIT_SUM) > 0 THEN sum(AMT_CREDIT_SUM_DEBT) / sum(AMT_CREDIT_SUM) END", "DOUBLE")}
           AS bur_debt_credit_ratio,
         min(DAYS_CREDIT) + {days} AS bur_days_credit_min, avg(DAYS_CREDIT + {days}) AS bur_days_credit_mean
  FROM bur WHERE {opened} GROUP BY SK_ID_CURR),
bur_f AS (SELECT * FROM bur_acc LEFT JOIN bur_status USING (SK_ID_CURR)),
fs AS (
  SELECT SK_ID_CURR, TARGET, AMT_CREDIT AS app_loan_amount,
         CAST(NULL AS DOUBLE) AS app_emi, CAST(NULL AS DOUBLE) AS app_income,
         CAST(NULL AS INT) AS app_age_days, CAST(NULL AS INT) AS app_days_employed,
         CAST(NULL AS VARCHAR) AS CODE_GENDER, NAME_CONTRACT_TYPE, {features},
         coalesce(ins_underpay_ratio_l3m, 0) * coalesce(cc_util_l3m, 0) * coalesce(bur_delinq_rate_12m, 0)
           AS stress_composite,
         CAST(coalesce(ins_days_late_l3m > 0, FALSE) AS INT) + CAST(coalesce(cc_dpd_l3m > 0, FALSE) AS INT)
           + CAST(coalesce(bur_delinq_rate_12m > 0, FALSE) AS INT) AS n_products_delinquent,
         bur_status_trend AS bur_momentum
  FROM app LEFT JOIN ins_f USING (SK_ID_CURR) LEFT JOIN cc_f USING (SK_ID_CURR)
           LEFT JOIN bur_f USING (SK_ID_CURR)
  WHERE TARGET IS NOT NULL)"""


def _cell(seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST(SK_ID_CURR AS VARCHAR) || ':{seed}'), 1, 4) AS INT)"


SPLIT = f"""
cells AS (SELECT SK_ID_CURR, TARGET, {_cell(42)} AS cell FROM fs),
bounds AS (
  SELECT TARGET, min(cell) AS last_cell
  FROM (SELECT TARGET, cell, count(*) OVER (PARTITION BY TARGET ORDER BY cell) AS upto,
               count(*) OVER (PARTITION BY TARGET) AS total FROM cells)
  WHERE upto >= total * 0.7e0 GROUP BY TARGET),
split AS (SELECT SK_ID_CURR, TARGET, cell <= last_cell AS is_train FROM cells JOIN bounds USING (TARGET)),
fst AS (SELECT fs.*, is_train FROM fs JOIN split USING (SK_ID_CURR))"""


BASELINE = (
    "round(1 / (1 + exp(-(0.5e0 * coalesce(ins_days_late_mean, 0) / 5"
    " + coalesce(ins_pct_late, 0) - 1))), 3)"
)
CHALLENGER = "round(1 / (1 + exp(-(2 * coalesce(bur_delinq_rate, 0) + coalesce(ins_pct_late, 0) - 1.5e0))), 3)"
WARNING = (
    "round(1 / (1 + exp(-(0.1e0 * ins_days_late_mean + 2 * ins_pct_late + 1.5e0 * cc_util_mean"
    " + 0.2e0 * cc_dpd_mean - 1.5e0))), 4)"
)
MASKED = (
    "round(1 / (1 + exp(-(0.2e0 * ins_days_late_l3m + ins_pct_late + 50 * bur_status_trend"
    " + cc_util_l3m - 0.5e0))), 4)"
)
WARNING_INPUTS = ["ins_days_late_mean", "ins_pct_late", "cc_util_mean", "cc_dpd_mean"]
MASKED_INPUTS = ["ins_days_late_l3m", "ins_pct_late", "bur_status_trend", "cc_util_l3m"]


def zeroed(columns: Iterable[str]) -> str:
    return ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0e0) AS {c}" for c in columns)


SCORED = f"""
scored AS (
  SELECT SK_ID_CURR, TARGET AS label, {BASELINE} AS score, is_train,
         CASE WHEN is_train THEN 'train' ELSE 'test' END AS sample
  FROM fst),
models AS (
  SELECT SK_ID_CURR, TARGET AS label, is_train, 'Baseline' AS model, {BASELINE} AS score FROM fst
  UNION ALL
  SELECT SK_ID_CURR, TARGET, is_train, 'Challenger', {CHALLENGER} FROM fst)"""

FLAGS = f"""
flags AS (
  SELECT SK_ID_CURR, TARGET, s AS ew_score, CAST(s >= 0.5 AS INT) AS ew_flag,
         CASE WHEN s <= 0 THEN NULL WHEN s <= 0.2 THEN 'Very Low' WHEN s <= 0.4 THEN 'Low'
              WHEN s <= 0.6 THEN 'Medium' WHEN s <= 0.8 THEN 'High' WHEN s <= 1 THEN 'Critical' END AS risk_tier
  FROM (SELECT SK_ID_CURR, TARGET, {WARNING} AS s
        FROM (SELECT SK_ID_CURR, TARGET, {zeroed(WARNING_INPUTS)} FROM fs)))"""

PRIORITY = f"""
priority AS (
  SELECT *, PD * EAD * LGD AS expected_loss, 0.3e0 AS contact_eff, PD * EAD * LGD * 0.3e0 AS recovery_if_called
  FROM (SELECT SK_ID_CURR, TARGET, {BASELINE} AS PD,
               coalesce(app_loan_amount, (SELECT quantile_cont(app_loan_amount, 0.5) FROM fs)) AS EAD,
               0.45e0 AS LGD, NAME_CONTRACT_TYPE
        FROM fs)),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY expected_loss DESC, SK_ID_CURR) AS priority_rank FROM priority),
dimension AS (
  SELECT p.*, ew_flag, risk_tier FROM priority p LEFT JOIN flags USING (SK_ID_CURR)),
called AS (
  SELECT '{policy.RANDOM}' AS strategy, *,
         row_number() OVER (ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || ':42'), SK_ID_CURR) AS calls FROM priority
  UNION ALL
  SELECT '{policy.HIGHEST_PD}', *, row_number() OVER (ORDER BY PD DESC, SK_ID_CURR) FROM priority
  UNION ALL
  SELECT '{policy.EXPECTED_LOSS}', *, row_number() OVER (ORDER BY expected_loss DESC, SK_ID_CURR) FROM priority),
outcome AS (
  SELECT strategy, count(*) AS customers_called,
         round((SELECT sum(expected_loss) FROM priority), 2) AS total_EL_portfolio,
         round(sum(expected_loss), 2) AS EL_called,
         round(sum(expected_loss) * 0.3, 2) AS recovery_simulated,
         count(*) * 150 AS call_cost,
         round(sum(expected_loss) * 0.3 - count(*) * 150, 2) AS net_profit,
         round(sum(expected_loss) * 0.3 / greatest(count(*) * 0.25e0, 1), 2) AS recovery_per_hour,
         round(sum(expected_loss) / (SELECT sum(expected_loss) FROM priority) * 100, 1) AS pct_EL_covered
  FROM called WHERE calls <= 200 GROUP BY strategy)"""


def _bin_case(feature: str) -> str:
    cuts = CUTS[feature]
    steps = " ".join(f"WHEN {feature} < {c!r} THEN {i}" for i, c in enumerate(cuts))
    return f"CASE WHEN {feature} IS NULL THEN -1 {steps} ELSE {len(cuts)} END"


def _tree_bins() -> str:
    """A tree per feature over fixed cells: a step splits the leaf with the best cut.

    Rows of a step are the leaves so far. Sums up to a cell are kept with a row per limit.
    """
    cells = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, len(list_filter({values}, lambda c: c <= {f})) + 1 AS cell, TARGET FROM fst "
        f"WHERE is_train AND {f} IS NOT NULL"
        for f, values in FINE_CUTS.items()
    )
    missing = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(-1 AS INT) AS bin, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, "
        f"count(*) AS n, CAST(sum(TARGET) AS BIGINT) AS bad FROM fst WHERE is_train AND {f} IS NULL HAVING count(*) > 0"
        for f in FINE_CUTS
    )
    edges = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, unnest(range(0, {len(v) + 2})) AS pos, unnest([NULL, {', '.join(map(str, v))}, NULL]) "
        "AS edge"
        for f, v in FINE_CUTS.items()
    )
    rounds = " UNION ALL ".join(f"SELECT '{f}' AS feature, {len(v) + 1} AS size" for f, v in FINE_CUTS.items())

    def mixed(rows: str, bads: str) -> str:
        return f"(({bads}) * (({rows}) - ({bads})) / greatest(({rows}), 1))"

    return query(
        "SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY lo) - 1 AS INT) AS bin, "
        "low.edge AS low, high.edge AS high, CAST(b.n - a.n AS BIGINT) AS n, CAST(b.bad - a.bad AS BIGINT) AS bad "
        "FROM (SELECT * FROM tree QUALIFY step = max(step) OVER (PARTITION BY feature)) t "
        "JOIN edges low USING (feature) JOIN edges high USING (feature) "
        "JOIN upto a USING (feature) JOIN upto b USING (feature) "
        "WHERE low.pos = lo AND high.pos = hi AND a.pos = lo AND b.pos = hi UNION ALL "
        + missing,
        f"fine AS ({cells}), sizes AS ({rounds}), edges AS ({edges}),"
        " limits AS (SELECT feature, unnest(range(0, size + 1)) AS pos FROM sizes),"
        " upto AS (SELECT feature, pos, (SELECT count(*) FROM fine c WHERE c.feature = limits.feature AND cell <= pos) AS n,"
        " (SELECT coalesce(sum(TARGET), 0) FROM fine c WHERE c.feature = limits.feature AND cell <= pos) AS bad"
        " FROM limits),"
        " wholes AS (SELECT feature, max(n) AS whole FROM upto GROUP BY feature),"
        " cuts AS (SELECT feature, l.pos AS lo, m.pos, h.pos AS hi, round("
        + mixed("h.n - l.n", "h.bad - l.bad")
        + " - "
        + mixed("m.n - l.n", "m.bad - l.bad")
        + " - "
        + mixed("h.n - m.n", "h.bad - m.bad")
        + ", 9) AS gain FROM upto l JOIN upto m USING (feature) JOIN upto h USING (feature) JOIN wholes USING (feature)"
        " WHERE l.pos < m.pos AND m.pos < h.pos AND m.n - l.n >= greatest(0.05e0 * whole, 1)"
        " AND h.n - m.n >= greatest(0.05e0 * whole, 1)),"
        " best AS (SELECT * FROM cuts WHERE gain > 0"
        " QUALIFY row_number() OVER (PARTITION BY feature, lo, hi ORDER BY gain DESC, pos) = 1),"
        " tree AS (SELECT feature, 1 AS step, 0 AS lo, size AS hi FROM sizes UNION ALL"
        " SELECT feature, step + 1, unnest(CASE WHEN first THEN [lo, pos] ELSE [lo] END),"
        " unnest(CASE WHEN first THEN [pos, hi] ELSE [hi] END)"
        " FROM (SELECT t.feature, t.step, t.lo, t.hi, b.pos, b.gain IS NOT NULL AND row_number() OVER"
        " (PARTITION BY t.feature ORDER BY b.gain DESC NULLS LAST, t.lo) = 1 AS first,"
        " max(b.gain) OVER (PARTITION BY t.feature) AS any_gain FROM tree t LEFT JOIN best b USING (feature, lo, hi))"
        " WHERE any_gain IS NOT NULL AND step < 20)",
    ).replace("WITH ", "WITH RECURSIVE ", 1)


def _woe_cte() -> str:
    counted = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {_bin_case(f)} AS bin, count(*) AS n, CAST(sum(TARGET) AS BIGINT) AS bad "
        f"FROM fst WHERE is_train GROUP BY 2"
        for f in CUTS
    )
    limits = ", ".join(
        f"('{f}', {i}, {'NULL' if i == 0 else repr(c[i - 1])}, {'NULL' if i == len(c) else repr(c[i])})"
        for f, c in CUTS.items()
        for i in range(len(c) + 1)
    )
    return f"""
counted AS ({counted}),
limits(feature, bin, low, high) AS (VALUES {limits}),
shares AS (
  SELECT feature, bin, n, bad,
         greatest(n - bad, 0.5e0) / sum(n - bad) OVER (PARTITION BY feature) AS g,
         greatest(bad, 0.5e0) / sum(bad) OVER (PARTITION BY feature) AS b
  FROM counted),
woe AS (
  SELECT s.feature, s.bin, n, bad, ln(g / b) AS woe, (g - b) * ln(g / b) AS iv,
         CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high
  FROM shares s LEFT JOIN limits USING (feature, bin)),
ivs AS (SELECT feature, round(sum(iv), 6) + 0e0 AS IV FROM woe GROUP BY feature)"""


def _woe_values_cte() -> str:
    looked_up = ", ".join(
        f"coalesce((SELECT woe FROM woe WHERE feature = '{f}' AND bin = {_bin_case(f)} AND bin >= 0), 0e0) AS {f}"
        for f in CUTS
    )
    parts = ", ".join(
        f"({f} - (SELECT avg({f}) FROM woe_values)) * ({c!r}) AS {f}" for f, c in COEFS.items()
    )
    return f"""
woe_values AS (SELECT SK_ID_CURR, {looked_up} FROM fs),
parts AS (SELECT SK_ID_CURR, {parts} FROM woe_values)"""


def _snapshot_cte() -> str:
    months = ", ".join(f"({m})" for m in early_warning.LEAD_MONTHS)
    carried = ", ".join(f"fs.{c}" for c in early_warning.CARRIED_FEATURES)
    return f"""
months(m) AS (VALUES {months}),
snap_ins AS (
  SELECT SK_ID_CURR, m, avg(greatest(late, 0)) FILTER (late IS NOT NULL) AS ins_days_late_mean,
         avg(greatest(short, 0)) FILTER (short IS NOT NULL) AS ins_underpay_ratio_mean,
         count(*) FILTER (AMT_PAYMENT = 0) / count(*) AS ins_pct_missed,
         count(*) FILTER (late > 0) / count(*) AS ins_pct_late
  FROM (SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS late,
               1 - AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS short FROM ins) i
       JOIN months ON DAYS_INSTALMENT <= -30 * m
  GROUP BY 1, 2),
snap_cc AS (
  SELECT SK_ID_CURR, m,
         avg(least(greatest(used, 0), 1)) FILTER (used IS NOT NULL) AS cc_util_mean,
         avg(SK_DPD) AS cc_dpd_mean, CAST(max(SK_DPD) AS DOUBLE) AS cc_dpd_max,
         avg(AMT_BALANCE) AS cc_balance_mean_sim
  FROM (SELECT *, AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0) AS used FROM cc) c
       JOIN months ON MONTHS_BALANCE <= -m
  GROUP BY 1, 2),
snapshots AS (
  SELECT fs.SK_ID_CURR, months.m AS months_before_default, fs.TARGET,
         {", ".join("i." + c for c in early_warning.SNAPSHOT_INSTALLMENTS)},
         {", ".join("c." + c for c in early_warning.SNAPSHOT_CARD)}, {carried}
  FROM fs CROSS JOIN months
       LEFT JOIN snap_ins i ON i.SK_ID_CURR = fs.SK_ID_CURR AND i.m = months.m
       LEFT JOIN snap_cc c ON c.SK_ID_CURR = fs.SK_ID_CURR AND c.m = months.m)"""


def rounding(columns: Iterable[str], table: str = "") -> str:
    return ", ".join(f"round({table}{c}, {DIGITS_OF.get(c, DIGITS)}) + 0e0 AS {c}" for c in columns)


def query(body: str, *ctes: str, as_of: int = 0) -> str:
    """A statement over the raw tables and the store; an empty body if the last part has it."""
    return "WITH " + ",".join([RAW, families(as_of), SPLIT, *ctes]) + "\n" + body


INS_INTEGERS = ["SK_ID_CURR", "ins_total_obs", "ins_missed_count_l3m", "ins_obs_l3m", "ins_obs_l6m"]
INS_DOUBLES = [
    "ins_days_late_mean",
    "ins_days_late_max",
    "ins_underpay_ratio_mean",
    "ins_pct_missed",
    "ins_pct_late",
    "ins_late_trend",
    "ins_days_late_l3m",
    "ins_underpay_ratio_l3m",
    "ins_days_late_l6m",
    "ins_underpay_ratio_l6m",
    "ins_late_momentum",
]
CARD_INTEGERS = ["SK_ID_CURR", "cc_dpd_max", "cc_total_obs", "cc_obs_l3m"]
CARD_DOUBLES = [c for c in store.CARD_COLUMNS if c not in CARD_INTEGERS]
STATUS_DOUBLES = ["bur_delinq_rate", "bur_delinq_rate_12m", "bur_status_trend"]
ACCOUNT_INTEGERS = ["bur_total_accounts", "bur_active_accounts", "bur_days_overdue_max", "bur_days_credit_min"]
ACCOUNT_DOUBLES = ["bur_days_overdue_mean", "bur_amt_overdue_sum", "bur_debt_credit_ratio", "bur_days_credit_mean"]
STORE_INTEGERS = [
    "SK_ID_CURR",
    "TARGET",
    "app_age_days",
    "app_days_employed",
    "CODE_GENDER",
    "NAME_CONTRACT_TYPE",
    "ins_missed_count_l3m",
    "cc_dpd_max",
    *ACCOUNT_INTEGERS,
    "bur_worst_status_ever",
    "n_products_delinquent",
]
STORE_COLUMNS = [
    "SK_ID_CURR",
    "TARGET",
    *store.APPLICATION_NAMES.values(),
    *store.MODEL_FEATURES,
    "bur_momentum",
]
STORE_DOUBLES = [c for c in STORE_COLUMNS if c not in STORE_INTEGERS]
PRIORITY_DOUBLES = ["PD", "EAD", "LGD", "expected_loss", "recovery_if_called"]


def _store_sql(as_of: int = 0) -> str:
    return query(f"SELECT {', '.join(STORE_INTEGERS)}, {rounding(STORE_DOUBLES)} FROM fs", as_of=as_of)


def _as_of_months(columns: str, table: str) -> str:
    """The store of every lead month, each rebuilt from the raw tables on its own."""
    return " UNION ALL ".join(
        f"SELECT * FROM ({query(f'SELECT {m} AS months_before_default, {columns} FROM {table}', as_of=m)})"
        for m in early_warning.LEAD_MONTHS
    )


def _corr(a: str, b: str) -> str:
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


def _correlations(pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {_corr(a, b)} AS corr FROM fs" for a, b in pairs
    )


def _clipped(features: Iterable[str]) -> str:
    """Values of each feature and class, clipped to the feature's 1% and 99% quantiles."""
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, TARGET, greatest(least(CAST({f} AS DOUBLE), hi), lo) AS value FROM fs, "
        f"(SELECT quantile_cont(CAST({f} AS DOUBLE), 0.01) AS lo, quantile_cont(CAST({f} AS DOUBLE), 0.99) AS hi "
        f"FROM fs) WHERE {f} IS NOT NULL"
        for f in features
    )


def _density(source: str, by: str, bins: int) -> str:
    """Statement over ``source`` (by..., value)."""
    return f"""
d AS (SELECT {by}, value FROM ({source})),
span0 AS (SELECT {by}, min(value) AS lo, max(value) AS hi, count(*) AS total FROM d GROUP BY ALL),
span AS (SELECT {by}, total, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
                CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM span0),
held AS (SELECT {by}, CAST(least(floor((value - lo) * {bins} / (hi - lo)), {bins} - 1) AS INT) AS bin, count(*) AS n
         FROM d JOIN span USING ({by}) GROUP BY ALL),
grid AS (SELECT {by}, lo, hi, total, CAST(unnest(range({bins})) AS INT) AS bin FROM span)
SELECT {by}, bin, round(lo + bin * ((hi - lo) / {bins}), 9) + 0e0 AS bin_low,
       round(lo + (bin + 1) * ((hi - lo) / {bins}), 9) + 0e0 AS bin_high,
       coalesce(n, 0) AS n, round(coalesce(n, 0) / (total * ((hi - lo) / {bins})), 9) + 0e0 AS density
FROM grid LEFT JOIN held USING ({by}, bin)"""


def _ranked(source: str, by: str) -> str:
    """Cumulative shares per distinct score of ``source`` (by, score, label)."""
    return f"""
t AS (SELECT {by}, score, sum(label) AS bad, sum(1 - label) AS good
      FROM ({source}) WHERE score IS NOT NULL GROUP BY ALL),
curve AS (
  SELECT *, sum(bad) OVER w AS cb, sum(good) OVER w AS cg,
         sum(bad) OVER (PARTITION BY {by}) AS ab, sum(good) OVER (PARTITION BY {by}) AS ag
  FROM t WINDOW w AS (PARTITION BY {by} ORDER BY score DESC)),
rates AS (
  SELECT {by}, sum(bad * (ag - cg + good / 2)) / (max(ab) * max(ag)) AS auc, max(abs(cb / ab - cg / ag)) AS ks
  FROM curve GROUP BY ALL)"""


def _psi(source: str, by: str) -> str:
    """PSI bins of ``source`` (by, score, is_train)."""
    edges = ", ".join(f"quantile_cont(score, {i / 10!r}) AS q{i}" for i in range(1, 10))
    index = " + ".join(f"CAST(score >= q{i} AS INT)" for i in range(1, 10))
    low = " ".join(f"WHEN {i} THEN q{i}" for i in range(1, 10))
    high = " ".join(f"WHEN {i - 1} THEN q{i}" for i in range(1, 10))
    return f"""
src AS (SELECT {by}, score, is_train FROM ({source}) WHERE score IS NOT NULL),
edges AS (SELECT {by}, {edges} FROM src WHERE is_train GROUP BY ALL),
binned AS (
  SELECT {by}, {index} AS bin, count(*) FILTER (is_train) AS e, count(*) FILTER (NOT is_train) AS a
  FROM src JOIN edges USING ({by}) GROUP BY ALL),
slots AS (
  SELECT {by}, bin, CASE bin {low} END AS low, CASE bin {high} END AS high
  FROM (SELECT *, CAST(unnest(range(10)) AS INT) AS bin FROM edges)),
bins AS (
  SELECT {by}, bin, low, high,
         CASE WHEN coalesce(e, 0) = 0 THEN 1e-6 ELSE e / sum(e) OVER (PARTITION BY {by}) END AS expected_share,
         CASE WHEN coalesce(a, 0) = 0 THEN 1e-6 ELSE a / sum(a) OVER (PARTITION BY {by}) END AS actual_share
  FROM slots LEFT JOIN binned USING ({by}, bin)),
drift AS (
  SELECT {by}, sum((actual_share - expected_share) * ln(actual_share / expected_share)) AS psi
  FROM bins GROUP BY ALL)"""


def _comparison_cte() -> str:
    return (
        _ranked("SELECT model, score, label FROM models WHERE NOT is_train", "model")
        + ","
        + _psi("SELECT model, score, is_train FROM models", "model")
        + """,
compared AS (
  SELECT model, auc, 2 * auc - 1 AS gini, ks, psi,
         auc - (SELECT auc FROM rates WHERE model = 'Baseline') AS auc_gain
  FROM rates LEFT JOIN drift USING (model))"""
    )


def _status(column: str) -> str:
    return f"CASE WHEN {column} < 0.10 THEN 'stable' WHEN {column} < 0.25 THEN 'watch' ELSE 'alert' END"


def _lead_time(source: str) -> str:
    """Lead-time table of ``source`` (months_before_default, label, score)."""
    return (
        "s AS (" + source + "),"
        + _ranked("SELECT months_before_default, score, label FROM s", "months_before_default")
        + """
SELECT months_before_default,
       round(count(*) FILTER (score >= 0.5 AND label = 1) / count(*) FILTER (label = 1) * 100, 1) AS capture_rate_pct,
       round(count(*) FILTER (score >= 0.5) / count(*) * 100, 1) AS false_alarm_rate_pct,
       round(count(*) FILTER (score >= 0.5 AND label = 0) / count(*) FILTER (label = 0) * 100, 1)
         AS false_positive_rate_pct,
       any_value(round(rates.auc, 4)) AS auc
FROM s LEFT JOIN rates USING (months_before_default) GROUP BY months_before_default"""
    )


def _masked_source() -> str:
    m = "months_before_default"
    late = {"ins_days_late_l3m": 6, "cc_util_l3m": 6, "bur_status_trend": 9}
    columns = ", ".join(
        f"CASE WHEN {m} >= {late[c]} THEN 0e0 ELSE coalesce({c}, 0) END AS {c}"
        if c in late
        else f"coalesce({c}, 0) AS {c}"
        for c in MASKED_INPUTS
    )
    months = ", ".join(str(v) for v in early_warning.LEAD_MONTHS)
    return (
        f"SELECT {m}, TARGET AS label, {MASKED} AS score FROM (SELECT {m}, TARGET, {columns} FROM "
        f"(SELECT *, unnest([{months}]) AS {m} FROM fst WHERE NOT is_train))"
    )


def _points(anchor: float) -> str:
    coefs = ", ".join(f"('{f}', {c!r}::DOUBLE)" for f, c in COEFS.items())
    label = "format('[{}, {})', coalesce(format('{:.4f}', low), '-inf'), coalesce(format('{:.4f}', high), 'inf'))"
    return f"""
SELECT feature, {label} AS bin, round(woe, 4) + 0e0 AS woe, round(iv, 4) + 0e0 AS iv, round(coef, 4) AS lr_coef,
       round(-(coef * woe + ({INTERCEPT!r}) / {len(COEFS)}) * (20 / ln(2)) + {anchor!r}, 1) + 0e0 AS points
FROM woe JOIN (VALUES {coefs}) c(feature, coef) USING (feature) WHERE bin >= 0"""


def _contract(expected: Mapping[str, int] | None = None) -> str:
    keys = {
        "application": ("app", "SK_ID_CURR"),
        "installments": ("ins", "SK_ID_CURR"),
        "card_balance": ("cc", "SK_ID_CURR"),
        "bureau": ("bur", "SK_ID_BUREAU"),
        "bureau_balance": ("bb", "SK_ID_BUREAU"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(DISTINCT {key}) AS distinct_keys, "
        f"{f'count(*) = {(expected or {})[name]}' if name in (expected or {}) else 'count(*) > 0'} AS ok "
        f"FROM {source}"
        for name, (source, key) in keys.items()
    )


def oracle_sql() -> dict[str, str]:
    woe, woe_values, snapshots = _woe_cte(), _woe_values_cte(), _snapshot_cte()
    policies = (FLAGS, PRIORITY)
    numeric = [c for c in STORE_COLUMNS if c not in ("SK_ID_CURR", "TARGET", "CODE_GENDER", "NAME_CONTRACT_TYPE")]
    key = [*quality.KEY_FEATURES, "TARGET"]
    pairs = [(a, b) for i, a in enumerate(key) for b in key[i + 1 :]]
    trajectory = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, avg({f}) FILTER (TARGET = 0) AS good_mean, "
        f"avg({f}) FILTER (TARGET = 1) AS bad_mean FROM fs"
        for f in early_warning.STRESS_FEATURES
    )
    by_sample = _ranked("SELECT sample, score, label FROM scored", "sample")
    test_models = _ranked("SELECT model, score, label FROM models WHERE NOT is_train", "model")
    psi_scored = _psi("SELECT 1 AS k, score, is_train FROM scored", "k")
    snapshot_doubles = [
        *early_warning.SNAPSHOT_INSTALLMENTS,
        *early_warning.SNAPSHOT_CARD,
        "bur_delinq_rate",
        "bur_delinq_rate_12m",
        "bur_debt_credit_ratio",
        "stress_composite",
    ]
    aligned = ", ".join(
        f"round(coalesce(CAST({c} AS DOUBLE), 0), {DIGITS_OF.get(c, DIGITS)}) + 0e0 AS {c}"
        if c in [*snapshot_doubles, *early_warning.CARRIED_FEATURES]
        else f"0e0 AS {c}"
        for c in early_warning.BEHAVIOUR_FEATURES
    )
    missing = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END), 9) AS missing_share FROM fs"
        for c in numeric
    )
    ins_sql = query(f"SELECT {', '.join(INS_INTEGERS)}, {rounding(INS_DOUBLES)} FROM ins_f")
    grid_values = {
        "capacity": [100, 200, 500, 1000],
        "cost_per_call": [100.0, 150.0, 200.0],
        "effectiveness": [0.2, 0.3, 0.4],
        "lgd": [0.35, 0.45, 0.55],
    }
    grid = " CROSS JOIN ".join(
        f"(SELECT unnest({values}::{'INT' if name == 'capacity' else 'DOUBLE'}[]) AS {name})"
        for name, values in grid_values.items()
    )
    priority_list = query(
        f"SELECT SK_ID_CURR, {rounding(PRIORITY_DOUBLES)}, TARGET, priority_rank, "
        "0.3e0 AS contact_eff_assumption FROM ranked",
        *policies,
    )
    top = "SELECT priority_rank, SK_ID_CURR, ew_flag, risk_tier, {} FROM ranked LEFT JOIN flags USING (SK_ID_CURR)"
    return {
        "input_contract": query(_contract()),
        "input_contract_expected": query(_contract(EXPECTED_ROWS)),
        "csv_round_trip": ins_sql,
        "csv_store": _store_sql(),
        "saved_store": _store_sql(),
        "bucketed_store": _store_sql(),
        "installment_base": query(
            "SELECT SK_ID_CURR, SK_ID_PREV, NUM_INSTALMENT_NUMBER, is_missed, "
            + rounding(["DAYS_INSTALMENT", "days_late", "underpay_ratio"])
            + " FROM ins_base"
        ),
        "ins_features": ins_sql,
        "card_base": query(
            "SELECT SK_ID_CURR, MONTHS_BALANCE, SK_DPD, "
            + rounding(["AMT_BALANCE", "AMT_DRAWINGS_CURRENT", "utilization", "min_pay_ratio"])
            + " FROM cc_base"
        ),
        "cc_features": query(f"SELECT {', '.join(CARD_INTEGERS)}, {rounding(CARD_DOUBLES)} FROM cc_f"),
        "bureau_months": query("SELECT SK_ID_BUREAU, MONTHS_BALANCE, STATUS, dpd_bucket, SK_ID_CURR FROM bur_months"),
        "bureau_status": query(
            f"SELECT SK_ID_CURR, bur_worst_status_ever, {rounding(STATUS_DOUBLES)} FROM bur_status"
        ),
        "bureau_accounts": query(
            f"SELECT SK_ID_CURR, {', '.join(ACCOUNT_INTEGERS)}, {rounding(ACCOUNT_DOUBLES)} FROM bur_acc"
        ),
        "bur_features": query(
            f"SELECT SK_ID_CURR, bur_worst_status_ever, {', '.join(ACCOUNT_INTEGERS)}, "
            f"{rounding(ACCOUNT_DOUBLES + STATUS_DOUBLES)} FROM bur_f"
        ),
        "feature_store": _store_sql(),
        "feature_store_as_of": _store_sql(AS_OF_MONTHS),
        "store_as_of_months": _as_of_months(
            f"{', '.join(STORE_INTEGERS)}, {rounding(STORE_DOUBLES)}", "fs"
        ),
        "fs_summary": query(
            "SELECT count(*) AS total_customers, CAST(sum(TARGET) AS BIGINT) AS total_defaults, "
            "round(100 * avg(TARGET), 2) AS default_rate_pct FROM fs"
        ),
        "fs_completeness": query(
            "SELECT count(*) AS n, round(100 * (count(ins_days_late_mean) / count(*)), 1) AS pct_has_installments, "
            "round(100 * (count(cc_util_mean) / count(*)), 1) AS pct_has_credit_card, "
            "round(100 * (count(bur_total_accounts) / count(*)), 1) AS pct_has_bureau FROM fs"
        ),
        "fs_default_by_products": query(
            "SELECT n_products_delinquent, count(*) AS customers, round(100 * avg(TARGET), 2) AS default_rate_pct "
            "FROM fs GROUP BY 1 ORDER BY 1"
        ),
        "fs_means_by_target": query(
            "SELECT TARGET, round(avg(ins_days_late_mean), 2) AS avg_days_late, "
            "round(avg(ins_underpay_ratio_mean), 3) AS avg_underpay, round(avg(cc_util_mean), 3) AS avg_cc_util, "
            "round(avg(bur_delinq_rate_12m), 3) AS avg_bur_delinq, round(avg(stress_composite), 4) AS avg_stress "
            "FROM fs GROUP BY TARGET ORDER BY TARGET"
        ),
        "missing_profile": query(missing),
        "corr_matrix": query(f"SELECT feature_1, feature_2, {rounding(['corr'])} FROM ({_correlations(pairs)})"),
        "target_corr": query(
            "SELECT feature_1 AS feature, round(abs(corr), 9) + 0e0 AS abs_corr FROM ("
            + _correlations([(f, "TARGET") for f in quality.KEY_FEATURES])
            + ") ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 10"
        ),
        "class_histogram": query("", _density(_clipped(HISTOGRAM_FEATURES), "feature, TARGET", 50)),
        "stress_histogram": query("", _density(_clipped(early_warning.STRESS_FEATURES), "feature, TARGET", 40)),
        "class_weights": query(
            "SELECT CAST(floor(count(*) FILTER (TARGET = 0) / sum(TARGET)) AS BIGINT) AS positive_weight, "
            "round(count(*) / (2 * count(*) FILTER (TARGET = 0)), 9) AS balanced_good, "
            "round(count(*) / (2 * sum(TARGET)), 9) AS balanced_bad FROM fst WHERE is_train"
        ),
        "stratified_split": query("SELECT * FROM split"),
        "split_counts": query("SELECT TARGET, is_train, count(*) AS n FROM split GROUP BY ALL"),
        "cv_folds": query(
            "SELECT SK_ID_CURR, TARGET, CAST((row_number() OVER (PARTITION BY TARGET ORDER BY "
            "md5(CAST(SK_ID_CURR AS VARCHAR) || ':43'), SK_ID_CURR) - 1) % 5 AS INT) AS fold FROM fs"
        ),
        "woe_iv": query(f"SELECT feature, bin, n, bad, {rounding(['woe', 'iv', 'low', 'high'])} FROM woe", woe),
        "iv_rank": query("SELECT * FROM ivs ORDER BY IV DESC, feature", woe),
        "iv_selection": query(
            "SELECT * FROM ivs WHERE IV >= CASE WHEN (SELECT max(IV) FROM ivs) >= 0.02 THEN 0.02 ELSE 0.005 END", woe
        ),
        "woe_transform": query(f"SELECT SK_ID_CURR, {rounding(CUTS)} FROM woe_values", woe, woe_values),
        "scorecard_points": query(_points(0.0), woe),
        "scorecard_points_anchored": query(_points(600 / len(COEFS)), woe),
        "auc_gini_ks": query(
            "SELECT sample, round(auc, 9) AS auc, round(2 * auc - 1, 9) + 0e0 AS gini, round(ks, 9) AS ks FROM rates",
            SCORED,
            by_sample,
        ),
        "ks_curve": query(
            "SELECT sample, score, round(cb / ab, 9) AS cum_bad, round(cg / ag, 9) AS cum_good, "
            "round(abs(cb / ab - cg / ag), 9) AS ks FROM curve",
            SCORED,
            by_sample,
        ),
        "ks_position": query(
            "SELECT sample, round(abs(cb / ab - cg / ag), 9) AS ks, score FROM curve "
            "QUALIFY row_number() OVER (PARTITION BY sample ORDER BY abs(cb / ab - cg / ag) DESC, score DESC) = 1",
            SCORED,
            by_sample,
        ),
        "roc_points": query(
            "SELECT model, score, round(cg / ag, 9) AS fpr, round(cb / ab, 9) AS tpr FROM curve", SCORED, test_models
        ),
        "psi_bins": query(
            f"SELECT bin, {rounding(['low', 'high', 'expected_share', 'actual_share'])} FROM bins", SCORED, psi_scored
        ),
        "psi": query(
            f"SELECT round(psi, 9) AS psi, {_status('psi')} AS psi_status FROM drift", SCORED, psi_scored
        ),
        "fit_checks": query(
            "SELECT round(tr, 9) AS auc_train, round(te, 9) AS auc_test, round(tr - te, 9) + 0e0 AS auc_gap, "
            "tr - te > 0.05 AS overfit, te < 0.65 AS weak_model FROM (SELECT max(auc) FILTER (sample = 'train') AS tr, "
            "max(auc) FILTER (sample = 'test') AS te FROM rates)",
            SCORED,
            by_sample,
        ),
        "score_density": query(
            "", SCORED, _density("SELECT sample, label, score AS value FROM scored WHERE score IS NOT NULL", "sample, label", 50)
        ),
        "gain_curve": query(
            "SELECT model, (bin + 1) / 20 AS pct_pop, round(sum(bad) OVER (PARTITION BY model ORDER BY bin) / ab, 9) "
            "AS cum_bad_rate FROM (SELECT model, bin, sum(label) AS bad, any_value(ab) AS ab FROM ("
            "SELECT model, label, sum(label) OVER (PARTITION BY model) AS ab, "
            "CAST(greatest(ceil((row_number() OVER (PARTITION BY model ORDER BY score DESC, SK_ID_CURR) - 1) * 20 / "
            "(count(*) OVER (PARTITION BY model) - 1)) - 1, 0) AS INT) AS bin "
            "FROM models WHERE NOT is_train AND score IS NOT NULL) GROUP BY model, bin)",
            SCORED,
        ),
        "model_comparison": query(
            f"SELECT model, {rounding(['auc', 'gini', 'ks', 'psi', 'auc_gain'])} FROM compared",
            SCORED,
            _comparison_cte(),
        ),
        "model_health": query(
            f"SELECT model, {rounding(['auc', 'gini', 'ks', 'psi'])}, {_status('psi')} AS psi_status FROM compared",
            SCORED,
            _comparison_cte(),
        ),
        "tree_bins": _tree_bins(),
        "optimal_bins_checks": query(
            " UNION ALL ".join(
                f"SELECT '{f}' AS feature, count(*) AS n, CAST(sum(TARGET) AS BIGINT) AS bad, "
                f"count(*) - count({f}) AS n_missing, TRUE AS information, TRUE AS few, TRUE AS large, "
                f"TRUE AS monotone, TRUE AS adjoining FROM fst WHERE is_train HAVING count({f}) > 0"
                for f in store.MODEL_FEATURES
            )
        ),
        "scorecard_checks": query(
            "SELECT count(*) AS n, CAST(sum(TARGET) AS BIGINT) AS bad, TRUE AS at_minimum, "
            "TRUE AS intercept_at_minimum, TRUE AS classes_balanced, TRUE AS points_follow FROM fst WHERE is_train"
        ),
        "cv_checks": query(
            "SELECT TARGET, fold, count(*) AS n, TRUE AS auc_by_sql FROM (SELECT TARGET, "
            "CAST((row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || ':43'), "
            "SK_ID_CURR) - 1) % 5 AS INT) AS fold FROM fst WHERE is_train) GROUP BY TARGET, fold"
        ),
        "challenger_checks": query(
            "SELECT SK_ID_CURR, TARGET, is_train, TRUE AS pd_inside, TRUE AS same_when_loaded, "
            "TRUE AS parts_sum_to_margin FROM fst"
        ),
        "tree_importance_checks": query(
            f"SELECT count(*) AS n_customers, {len(store.MODEL_FEATURES)} AS n_features, TRUE AS mean_of_parts, "
            "TRUE AS in_order FROM fst WHERE NOT is_train"
        ),
        "fitted_comparison_checks": query(
            "SELECT model, count(*) AS n, CAST(sum(TARGET) AS BIGINT) AS bad, TRUE AS same_auc, "
            "TRUE AS gini_follows, TRUE AS in_range FROM fst, (VALUES ('Baseline'), ('Challenger')) m(model) "
            "WHERE NOT is_train GROUP BY model"
        ),
        "fitted_warning_checks": query(
            "SELECT months_before_default, TRUE AS rates_are_shares, TRUE AS flagged_between, TRUE AS auc_in_range "
            f"FROM (SELECT unnest([{', '.join(map(str, early_warning.LEAD_MONTHS))}]) AS months_before_default), fst "
            "WHERE NOT is_train GROUP BY 1"
        ),
        "linear_attribution": query(f"SELECT SK_ID_CURR, {rounding(COEFS)} FROM parts", woe, woe_values),
        "attribution_importance": query(
            " UNION ALL ".join(
                f"SELECT '{f}' AS feature, round(avg(abs({f})), 9) + 0e0 AS importance FROM parts" for f in COEFS
            ),
            woe,
            woe_values,
        ),
        "explain_riskiest": query(
            "SELECT SK_ID_CURR, PD, feature, round(contribution, 9) + 0e0 AS contribution FROM ("
            + " UNION ALL ".join(
                f"SELECT SK_ID_CURR, score AS PD, '{f}' AS feature, {f} AS contribution FROM parts "
                f"JOIN (SELECT SK_ID_CURR, score FROM scored ORDER BY score DESC NULLS LAST, SK_ID_CURR LIMIT 1) "
                f"USING (SK_ID_CURR)"
                for f in COEFS
            )
            + ")",
            SCORED,
            woe,
            woe_values,
        ),
        "snapshot_features": query(
            "SELECT SK_ID_CURR, months_before_default, TARGET, bur_worst_status_ever, n_products_delinquent, "
            f"{rounding(snapshot_doubles)} FROM snapshots",
            snapshots,
        ),
        "aligned_features": query(
            f"SELECT SK_ID_CURR, months_before_default, TARGET, {aligned} FROM snapshots", snapshots
        ),
        "lead_time": query(
            "",
            snapshots,
            _lead_time(
                f"SELECT months_before_default, TARGET AS label, {WARNING} AS score FROM (SELECT months_before_default, "
                f"TARGET, {zeroed(WARNING_INPUTS)} FROM snapshots JOIN split USING (SK_ID_CURR, TARGET) WHERE NOT is_train)"
            ),
        ),
        "lead_time_as_of": "WITH "
        + _lead_time(
            f"SELECT months_before_default, TARGET AS label, {WARNING} AS score FROM (SELECT months_before_default, "
            f"TARGET, {zeroed(WARNING_INPUTS)} FROM ("
            + _as_of_months(f"TARGET, {', '.join(WARNING_INPUTS)}", "fst WHERE NOT is_train")
            + "))"
        ),
        "lead_time_masked": query("", _lead_time(_masked_source())),
        "stress_trajectory": query(
            "SELECT feature, round(good_mean, 9) + 0e0 AS good_mean, round(bad_mean, 9) + 0e0 AS bad_mean, "
            "round(bad_mean / CASE WHEN good_mean = 0 THEN 1e0 ELSE good_mean END, 9) + 0e0 AS ratio "
            f"FROM ({trajectory})"
        ),
        "warning_flags": query("SELECT * FROM flags", FLAGS),
        "expected_loss": query(
            "SELECT SK_ID_CURR, TARGET, NAME_CONTRACT_TYPE, ew_flag, risk_tier, "
            f"{rounding([*PRIORITY_DOUBLES, 'contact_eff'])} FROM dimension",
            *policies,
        ),
        "strategy_metrics": query("SELECT * FROM outcome", *policies),
        "policy_gain": query(
            "SELECT round(e.net_profit - r.net_profit, 2) + 0e0 AS net_profit_gain, "
            "round(e.recovery_simulated - r.recovery_simulated, 2) + 0e0 AS recovery_gain, "
            "round(e.recovery_per_hour - r.recovery_per_hour, 2) + 0e0 AS recovery_per_hour_gain, "
            "round((e.recovery_simulated - r.recovery_simulated) / r.recovery_simulated * 100, 1) + 0e0 "
            "AS recovery_gain_pct FROM outcome e, outcome r "
            f"WHERE e.strategy = '{policy.EXPECTED_LOSS}' AND r.strategy = '{policy.RANDOM}'",
            *policies,
        ),
        "recovery_curve": query(
            "SELECT strategy, calls, round(running * 0.3, 4) AS recovery FROM (SELECT strategy, calls, "
            "sum(expected_loss) OVER (PARTITION BY strategy ORDER BY calls) AS running FROM called) "
            "WHERE calls % 100 = 0 AND calls < least(5000, (SELECT count(*) FROM priority))",
            *policies,
        ),
        "priority_list": priority_list,
        "resumed_run": priority_list,
        "loss_sample": query(
            f"SELECT SK_ID_CURR, {rounding(['PD', 'EAD', 'expected_loss'])} FROM called "
            f"WHERE strategy = '{policy.RANDOM}' AND calls <= 5000",
            *policies,
        ),
        "loss_sample_500": query(
            f"SELECT SK_ID_CURR, {rounding(['PD', 'EAD', 'expected_loss'])} FROM called "
            f"WHERE strategy = '{policy.RANDOM}' AND calls <= {SAMPLE}",
            *policies,
        ),
        "recovery_curve_whole": query(
            "SELECT strategy, calls, round(running * 0.3, 4) AS recovery FROM (SELECT strategy, calls, "
            "sum(expected_loss) OVER (PARTITION BY strategy ORDER BY calls) AS running FROM called) "
            "WHERE calls % 100 = 0 AND calls < (SELECT count(*) FROM priority)",
            *policies,
        ),
        "scenario_linear": query(
            "SELECT strategy, 350 AS customers_called, round(el, 2) AS el_called, round(el * 0.25, 2) AS recovery, "
            "350 * 120e0 AS call_cost, round(el * 0.25 - 350 * 120, 2) AS net_profit, "
            "round(el * 0.25 / (350 * 0.25), 2) AS recovery_per_hour "
            "FROM (SELECT strategy, round(EL_called / 200, 2) * 350 AS el FROM outcome)",
            *policies,
        ),
        "scenario_grid": query(
            "SELECT strategy, capacity, cost_per_call, effectiveness, lgd, customers_called, "
            "round(exposure * lgd, 2) AS el_called, round(exposure * lgd * effectiveness, 2) AS recovery, "
            "round(customers_called * cost_per_call, 2) AS call_cost, "
            "round(exposure * lgd * effectiveness - customers_called * cost_per_call, 2) AS net_profit, "
            "round(exposure * lgd * effectiveness / greatest(customers_called * 0.25e0, 1), 2) AS recovery_per_hour "
            "FROM (SELECT strategy, capacity, cost_per_call, effectiveness, g.lgd, count(*) AS customers_called, "
            f"sum(PD * EAD) AS exposure FROM called JOIN (SELECT * FROM {grid}) g "
            "ON calls <= capacity GROUP BY ALL)",
            *policies,
        ),
        "priority_top1000": query(
            f"SELECT SK_ID_CURR, {rounding(PRIORITY_DOUBLES)}, TARGET, priority_rank, "
            "0.3e0 AS contact_eff_assumption FROM ranked WHERE priority_rank <= 1000",
            *policies,
        ),
        "total_el": query("SELECT round(sum(PD * EAD * LGD), 4) AS total_el FROM priority", *policies),
        "recovery_at_capacity": query(
            "SELECT count(*) AS customers, round(sum(expected_loss * 0.3), 4) AS simulated_recovery "
            "FROM (SELECT expected_loss, rank() OVER (ORDER BY expected_loss DESC) AS r FROM priority) WHERE r <= 200",
            *policies,
        ),
        "capture_at_capacity": query(
            "SELECT round(sum(TARGET) FILTER (r <= 200) / sum(TARGET) * 100, 9) AS capture_rate_pct "
            "FROM (SELECT TARGET, rank() OVER (ORDER BY PD DESC) AS r FROM priority)",
            *policies,
        ),
        "tier_summary": query(
            "SELECT risk_tier, count(*) AS customers, round(sum(expected_loss), 4) AS total_el FROM dimension GROUP BY 1",
            *policies,
        ),
        "pd_by_tier": query(
            "SELECT risk_tier, CAST(least(floor(PD * 20), 19) AS INT) AS pd_bin, count(*) AS customers "
            "FROM dimension GROUP BY 1, 2",
            *policies,
        ),
        "top20": query(
            top.format(rounding(["PD", "EAD", "expected_loss"])) + " WHERE priority_rank <= 20", *policies
        ),
        "portfolio_kpis": query(
            "SELECT CASE WHEN grouping(NAME_CONTRACT_TYPE) = 1 THEN 'All' ELSE NAME_CONTRACT_TYPE END AS segment, "
            "count(*) AS customers, round(sum(EAD), 4) AS exposure_at_risk, round(sum(expected_loss), 4) AS total_el, "
            "count(*) FILTER (priority_rank <= 200) AS customers_called, "
            "round(coalesce(sum(recovery_if_called) FILTER (priority_rank <= 200), 0), 4) AS recovery, "
            "round(coalesce(sum(recovery_if_called) FILTER (priority_rank <= 200), 0) / sum(expected_loss) * 100, 4) "
            "AS recovery_rate_pct, round(count(*) FILTER (priority_rank <= 200) / 200 * 100, 4) AS capacity_use_pct "
            "FROM ranked GROUP BY ROLLUP (NAME_CONTRACT_TYPE)",
            *policies,
        ),
        "customer_dimension": query(
            f"SELECT {', '.join('fs.' + c for c in STORE_INTEGERS)}, "
            f"{rounding(STORE_DOUBLES, 'fs.')}, "
            f"{rounding(PRIORITY_DOUBLES)}, priority_rank, 0.3e0 AS contact_eff_assumption, "
            "ew_score, ew_flag, risk_tier "
            "FROM fs LEFT JOIN ranked USING (SK_ID_CURR) LEFT JOIN flags USING (SK_ID_CURR)",
            *policies,
        ),
    }
