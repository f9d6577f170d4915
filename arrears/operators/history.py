"""The feature store as of many earlier months, from one pass over the raw tables.

Rows of a customer that the same months see in the same way are one cell of counts, sums,
sums of products and maxima. How a row is seen changes with the month in one direction
only: it has to be due by then, it lies in a recent window of the later months back, its
payment is known from some month on. So a cell is named by how many of the wanted months
do each of that, and a customer has a few cells per month however many rows there are.
Every feature of every month is then a merge of cells.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.operators import bureau, card, installments
from arrears.operators.early_warning import LEAD_MONTHS
from arrears.operators.installments import DAYS_PER_MONTH
from arrears.operators.store import application_spine, with_families
from arrears.sources.tables import Tables

MONTH = "months_before_default"
LAST_YEAR = -12


class Months:
    """The wanted months in ascending order, and which of them a cell belongs to."""

    def __init__(self, months: Sequence[int]):
        if not months or min(months) < 0:
            raise ValueError("months back are needed, from 0 on")
        self.values = sorted(set(months))

    def count(self, condition) -> Column:
        """In how many months a condition holds; ``condition`` takes a month."""
        return reduce(add, [F.when(condition(m), 1).otherwise(0) for m in self.values])

    def month(self) -> Column:
        """The month of a row that ``spread`` has made."""
        return F.array(*[F.lit(m) for m in self.values])[F.col("_at")]

    def spread(self, cells: DataFrame) -> DataFrame:
        """Cells once for each month that has ``_seen`` them: the first so many."""
        places = F.sequence(F.lit(0), F.col("_seen") - 1)
        rows = cells.where("_seen > 0").withColumn("_at", F.explode(places))
        return rows.withColumn(MONTH, self.month())

    def first(self, count: str) -> Column:
        """Whether the month is among the first so many."""
        return F.col("_at") < F.col(count)

    def last(self, count: str) -> Column:
        """Whether the month is among the last so many."""
        return F.col("_at") >= len(self.values) - F.col(count)


def _line_cells(y: Column, x: Column, name: str) -> list[Column]:
    """What the slope of ``y`` over ``x`` needs of a cell."""
    at = F.when(y.isNotNull(), x).cast("double")
    value = F.when(x.isNotNull(), y).cast("double")
    parts = {"n": F.count(value), "x": F.sum(at), "y": F.sum(value), "xx": F.sum(at * at)}
    parts |= {"xy": F.sum(at * value), "low": F.min(at), "high": F.max(at)}
    return [part.alias(f"_{name}_{key}") for key, part in parts.items()]


def _slope(name: str, rows: Column) -> Column:
    """The slope over the merged cells; null without two places of ``x``.

    Days and months are whole numbers, whose sums of squares are exact.
    """

    def total(key: str) -> Column:
        return F.sum(F.when(rows, F.col(f"_{name}_{key}")))

    n = total("n").cast("double")
    over = n * total("xx") - total("x") * total("x")
    slope = F.try_divide(n * total("xy") - total("x") * total("y"), over)
    low, high = (f(F.when(rows, F.col(f"_{name}_{key}"))) for f, key in ((F.min, "low"), (F.max, "high")))
    return F.when(low < high, slope)


def _mean_cells(values: Mapping[str, Column]) -> list[Column]:
    return [
        part.alias(f"_{name}_{key}")
        for name, value in values.items()
        for key, part in (("n", F.count(value)), ("sum", F.sum(value.cast("double"))))
    ]


def _mean(name: str, rows: Column) -> Column:
    return F.try_divide(
        F.sum(F.when(rows, F.col(f"_{name}_sum"))), F.sum(F.when(rows, F.col(f"_{name}_n")))
    )


def installment_history(rows: DataFrame, months: Months) -> DataFrame:
    """``installment_features`` by customer and month."""
    days = {m: m * DAYS_PER_MONTH for m in months.values}
    due, paid_on = F.col("DAYS_INSTALMENT"), F.col("DAYS_ENTRY_PAYMENT")
    late = paid_on - due
    short = F.greatest(F.lit(0.0), 1 - F.try_divide("AMT_PAYMENT", "AMT_INSTALMENT"))
    base = rows.where((due <= -days[months.values[0]]) & (F.col("AMT_INSTALMENT") >= 0))
    cells = base.groupBy(
        "SK_ID_CURR",
        months.count(lambda m: due <= -days[m]).alias("_seen"),
        months.count(lambda m: due + days[m] >= installments.LAST_3_MONTHS).alias("_recent_3"),
        months.count(lambda m: due + days[m] >= installments.LAST_6_MONTHS).alias("_recent_6"),
        # A payment without a day stays; today's store knows all payments.
        months.count(
            lambda m: F.lit(True) if m == 0 else paid_on.isNull() | (paid_on + days[m] <= 0)
        ).alias("_known"),
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        *_mean_cells({"late": late}),
        F.max(late).alias("_late_max"),
        F.count(F.when(late > 0, 1)).alias("_late"),
        F.sum(short).alias("_short"),
        F.count(F.when(F.col("AMT_PAYMENT") == 0, 1)).alias("_missed"),
        *_line_cells(late, due, "trend"),
    )
    known, in_3m, in_6m = months.first("_known"), months.last("_recent_3"), months.last("_recent_6")

    def seen(column: str, rows: Column = known) -> Column:
        """A sum over the rows; what hangs on an unknown payment is zero."""
        return F.sum(F.when(rows, F.when(known, F.col(column)).otherwise(F.lit(0))))

    def count(rows: Column) -> Column:
        return F.sum(F.when(rows, F.col("_n")))

    every = F.lit(True)
    merged = months.spread(cells).groupBy("SK_ID_CURR", MONTH).agg(
        _mean("late", known).alias("ins_days_late_mean"),
        F.max(F.when(known, F.col("_late_max"))).alias("ins_days_late_max"),
        F.try_divide(seen("_short", every), count(every)).alias("ins_underpay_ratio_mean"),
        F.try_divide(seen("_missed", every), count(every)).alias("ins_pct_missed"),
        F.try_divide(seen("_late", every), count(every)).alias("ins_pct_late"),
        _slope("trend", known).alias("ins_late_trend"),
        _mean("late", known & in_3m).alias("ins_days_late_l3m"),
        F.try_divide(seen("_short", in_3m), count(in_3m)).alias("ins_underpay_ratio_l3m"),
        seen("_missed", in_3m).alias("ins_missed_count_l3m"),
        _mean("late", known & in_6m).alias("ins_days_late_l6m"),
        F.try_divide(seen("_short", in_6m), count(in_6m)).alias("ins_underpay_ratio_l6m"),
    )
    momentum = F.coalesce("ins_days_late_l3m", F.lit(0.0)) - F.coalesce("ins_days_late_l6m", F.lit(0.0))
    return merged.withColumn("ins_late_momentum", momentum)


def card_history(rows: DataFrame, months: Months) -> DataFrame:
    """``card_features`` by customer and month."""
    base = card.card_base(rows, months.values[0])
    # The base counts its months from the first wanted one.
    month = F.col("MONTHS_BALANCE") - months.values[0]
    used, paid, dpd = F.col("utilization"), F.col("min_pay_ratio"), F.col("SK_DPD")
    balance, drawings = F.col("AMT_BALANCE"), F.col("AMT_DRAWINGS_CURRENT")
    cells = base.groupBy(
        "SK_ID_CURR",
        months.count(lambda m: month < -m).alias("_seen"),
        months.count(lambda m: month + m >= card.LAST_3_MONTHS).alias("_recent_3"),
    ).agg(
        *_mean_cells({"used": used, "balance": balance, "dpd": dpd, "paid": paid}),
        F.max(used).alias("_used_max"),
        F.max(dpd).alias("_dpd_max"),
        *_line_cells(used, month, "used_trend"),
        *_line_cells(balance, month, "balance_trend"),
        *_line_cells(drawings, month, "drawings_trend"),
    )
    every, in_3m = F.lit(True), months.last("_recent_3")
    return months.spread(cells).groupBy("SK_ID_CURR", MONTH).agg(
        _mean("used", every).alias("cc_util_mean"),
        F.max("_used_max").alias("cc_util_max"),
        _mean("used", in_3m).alias("cc_util_l3m"),
        _slope("used_trend", every).alias("cc_util_trend"),
        _mean("balance", every).alias("cc_balance_mean"),
        _mean("balance", in_3m).alias("cc_balance_l3m"),
        _slope("balance_trend", every).alias("cc_balance_trend"),
        _mean("dpd", every).alias("cc_dpd_mean"),
        F.max("_dpd_max").alias("cc_dpd_max"),
        _mean("dpd", in_3m).alias("cc_dpd_l3m"),
        _mean("paid", every).alias("cc_min_pay_ratio_mean"),
        _mean("paid", in_3m).alias("cc_min_pay_ratio_l3m"),
        _slope("drawings_trend", every).alias("cc_drawings_trend"),
    )


def bureau_status_history(accounts: DataFrame, balance: DataFrame, months: Months) -> DataFrame:
    """``bureau_status`` by customer and month: cells of accounts meet their owners."""
    base = bureau.bucketed_months(balance, months.values[0])
    month = (F.col("MONTHS_BALANCE") - months.values[0]).cast("bigint")
    bucket = F.col("dpd_bucket")
    delinquent = bucket >= 1
    cells = base.groupBy(
        "SK_ID_BUREAU",
        months.count(lambda m: month < -m).alias("_seen"),
        months.count(lambda m: month + m >= LAST_YEAR).alias("_last_year"),
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(bucket).alias("_with_bucket"),
        F.count(F.when(delinquent, 1)).alias("_bad"),
        F.max(bucket).alias("_worst"),
        *_line_cells(bucket, month, "trend"),
    )
    owned = cells.join(accounts.select("SK_ID_BUREAU", "SK_ID_CURR"), "SK_ID_BUREAU")
    every, in_year = F.lit(True), months.last("_last_year")
    return months.spread(owned).groupBy("SK_ID_CURR", MONTH).agg(
        F.try_divide(F.sum("_bad"), F.sum("_n")).alias("bur_delinq_rate"),
        F.try_divide(
            F.sum(F.when(in_year, F.col("_bad"))), F.sum(F.when(in_year, F.col("_with_bucket")))
        ).alias("bur_delinq_rate_12m"),
        F.max("_worst").alias("bur_worst_status_ever"),
        _slope("trend", every).alias("bur_status_trend"),
    )


def bureau_account_history(accounts: DataFrame, months: Months) -> DataFrame:
    """``bureau_accounts`` by customer and month; what only today knows is null before."""
    opened = F.col("DAYS_CREDIT")
    credit, debt = F.col("AMT_CREDIT_SUM"), F.col("AMT_CREDIT_SUM_DEBT")
    cells = accounts.groupBy(
        "SK_ID_CURR",
        months.count(lambda m: F.lit(True) if m == 0 else opened <= -m * DAYS_PER_MONTH).alias("_seen"),
    ).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(opened).alias("_oldest"),
        F.count(F.when(F.col("CREDIT_ACTIVE") == "Active", 1)).alias("_active"),
        *_mean_cells({"overdue": F.col("CREDIT_DAY_OVERDUE")}),
        F.max("CREDIT_DAY_OVERDUE").alias("_overdue_max"),
        F.sum("AMT_CREDIT_SUM_OVERDUE").alias("_overdue"),
        F.sum(credit).alias("_credit"),
        F.sum(debt).alias("_debt"),
    )
    today = F.col(MONTH) == 0
    ratio = F.when(F.sum("_credit") > 0, F.try_divide(F.sum("_debt"), F.sum("_credit")))
    merged = months.spread(cells).groupBy("SK_ID_CURR", MONTH).agg(
        F.sum("_n").alias("bur_total_accounts"),
        (F.min("_oldest") + F.col(MONTH) * DAYS_PER_MONTH).alias("bur_days_credit_min"),
        F.sum("_active").alias("bur_active_accounts"),
        _mean("overdue", F.lit(True)).alias("bur_days_overdue_mean"),
        F.max("_overdue_max").alias("bur_days_overdue_max"),
        F.sum("_overdue").alias("bur_amt_overdue_sum"),
        ratio.alias("bur_debt_credit_ratio"),
    )
    only_now = [c for c in merged.columns[4:]]
    return merged.withColumns({c: F.when(today, F.col(c)) for c in only_now})


def store_as_of_months(tables: Tables, months: Sequence[int] = LEAD_MONTHS) -> DataFrame:
    """Every labelled customer as ``feature_store(tables, as_of=m)`` shows it, for each month.

    Each raw table is aggregated to cells once, with map-side combine, so the raw rows are
    read once and only cells are shuffled. Months may be given in any order; 0 is today.
    """
    wanted = Months(months)
    accounts = tables["bureau"]
    on = ["SK_ID_CURR", MONTH]
    families = [
        installment_history(tables["installments"], wanted),
        card_history(tables["card_balance"], wanted),
        bureau_account_history(accounts, wanted).join(
            bureau_status_history(accounts, tables["bureau_balance"], wanted), on, "left"
        ),
    ]
    back = F.explode(F.array(*[F.lit(m) for m in wanted.values]))
    labelled = tables["application"].where(F.col("TARGET").isNotNull()).withColumn(MONTH, back)
    spine = application_spine(labelled, F.col(MONTH) * DAYS_PER_MONTH, [MONTH])
    return with_families(spine, families, on)
