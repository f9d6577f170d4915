import numpy as np
import pytest
from arrears.operators import bureau, card, early_warning, installments, store
from arrears.sources import tables, tpch

from tests.conftest import SMALL

INS = (
    "SK_ID_CURR bigint, SK_ID_PREV bigint, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT double, "
    "DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double"
)
CARD = (
    "SK_ID_CURR bigint, MONTHS_BALANCE int, AMT_BALANCE double, AMT_CREDIT_LIMIT_ACTUAL double, "
    "AMT_PAYMENT_CURRENT double, AMT_INST_MIN_REGULARITY double, AMT_DRAWINGS_CURRENT double, SK_DPD int"
)
BUREAU = (
    "SK_ID_CURR bigint, SK_ID_BUREAU bigint, CREDIT_ACTIVE string, CREDIT_DAY_OVERDUE int, "
    "AMT_CREDIT_SUM_OVERDUE double, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, DAYS_CREDIT int"
)
BALANCE = "SK_ID_BUREAU bigint, MONTHS_BALANCE int, STATUS string"


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_single_instalment_has_no_trend(spark):
    df = spark.createDataFrame([(1, 1, 1, -10.0, -5.0, 100.0, 100.0)], INS)
    r = one(installments.installment_features(df))
    assert r.ins_late_trend is None
    assert (r.ins_days_late_mean, r.ins_obs_l3m, r.ins_late_momentum) == (5.0, 1, 0.0)


def test_shortfall_of_unpaid_and_zero_instalments(spark):
    rows = [(1, 1, 1, -400.0, None, 0.0, None), (1, 1, 2, -300.0, None, 50.0, None), (1, 1, 3, 5.0, 1.0, 9.0, 0.0)]
    df = spark.createDataFrame(rows, INS)
    r = one(installments.installment_features(df))
    assert r.ins_total_obs == 2  # the future due date is out
    assert r.ins_underpay_ratio_mean == 0.0
    assert r.ins_days_late_mean is None
    assert r.ins_pct_late == 0.0
    assert (r.ins_obs_l3m, r.ins_missed_count_l3m, r.ins_days_late_l3m) == (None, None, None)
    snapshot = one(df.groupBy("SK_ID_CURR").agg(*early_warning.installment_snapshots([1, 12])))
    assert snapshot.ins_underpay_ratio_mean_1 is None
    assert (snapshot.ins_pct_missed_1, snapshot.ins_pct_missed_12) == (0.0, 0.0)


def test_window_edges(spark):
    rows = [(1, 1, i, float(d), float(d) + late, 10.0, 10.0) for i, (d, late) in enumerate([(-91, 2), (-92, 4), (-182, 6), (-183, 8)])]
    r = one(installments.installment_features(spark.createDataFrame(rows, INS)))
    assert (r.ins_obs_l3m, r.ins_obs_l6m) == (1, 3)
    assert (r.ins_days_late_l3m, r.ins_days_late_l6m, r.ins_late_momentum) == (2.0, 4.0, -2.0)


def test_as_of_hides_later_payments(spark):
    rows = [
        (1, 1, 1, -100.0, -95.0, 10.0, 10.0),
        (1, 1, 2, -92.0, -80.0, 10.0, 0.0),  # due before, paid after the snapshot
        (1, 1, 3, -50.0, -50.0, 10.0, 10.0),  # due after the snapshot
    ]
    r = one(installments.installment_features(spark.createDataFrame(rows, INS), as_of=3))
    assert (r.ins_total_obs, r.ins_days_late_mean, r.ins_pct_missed) == (2, 5.0, 0.0)


def test_as_of_zero_is_the_store(spark):
    raw = tpch.tables(spark, SMALL)
    assert store.feature_store(raw, 0).exceptAll(store.feature_store(raw)).count() == 0


def test_card_month_zero_and_limits(spark):
    rows = [
        (1, 0, 999.0, 10.0, 1.0, 1.0, 0.0, 9),
        (1, -1, 50.0, 100.0, 5.0, 10.0, 1.0, 0),
        (1, -3, 30.0, 0.0, 5.0, 0.0, 1.0, 2),
        (1, -4, 150.0, 100.0, None, 10.0, 1.0, 4),
    ]
    df = spark.createDataFrame(rows, CARD)
    r = one(card.card_features(df))
    assert (r.cc_total_obs, r.cc_obs_l3m, r.cc_dpd_max) == (3, 2, 4)
    assert (r.cc_util_mean, r.cc_util_max, r.cc_util_l3m) == (1.0, 1.5, 0.5)
    assert r.cc_min_pay_ratio_mean == 0.5
    assert r.cc_drawings_trend == 0.0
    assert one(card.card_features(df, as_of=1)).cc_total_obs == 2
    assert one(df.groupBy("SK_ID_CURR").agg(*early_warning.card_snapshots([1]))).cc_util_mean_1 == 0.75


def accounts(spark):
    rows = [(1, 10, "Active", 0, 0.0, 100.0, 50.0, -30), (1, 11, "Closed", 4, 2.0, 0.0, None, -300), (2, 12, "Sold", 0, 0.0, 0.0, 1.0, -5)]
    return spark.createDataFrame(rows, BUREAU)


def test_status_codes_and_year_edge(spark):
    rows = [(10, 0, "5"), (10, -1, "0"), (10, -12, "1"), (10, -13, "5"), (11, -2, "X"), (11, -3, "C"), (11, -4, "?"), (99, -1, "5")]
    balance = spark.createDataFrame(rows, BALANCE)
    r = one(bureau.bureau_status(accounts(spark), balance))
    assert r.bur_delinq_rate == pytest.approx(2 / 6)  # unknown months count as good
    assert r.bur_delinq_rate_12m == pytest.approx(1 / 3)  # unknown months are left out
    assert r.bur_worst_status_ever == 5
    x, y = [-1, -12, -13, -3], [0, 1, 5, 0]
    assert r.bur_status_trend == pytest.approx(np.polyfit(x, y, 1)[0])


def test_status_without_spread_has_no_trend(spark):
    balance = spark.createDataFrame([(10, -5, "1"), (11, -5, "3")], BALANCE)
    assert one(bureau.bureau_status(accounts(spark), balance)).bur_status_trend is None


def test_duplicate_accounts_count_their_months_twice(spark):
    twice = accounts(spark).union(accounts(spark).where("SK_ID_BUREAU = 10"))
    balance = spark.createDataFrame([(10, -1, "1"), (11, -1, "0")], BALANCE)
    assert one(bureau.bureau_status(twice, balance)).bur_delinq_rate == pytest.approx(2 / 3)


def test_account_aggregates(spark):
    rows = {r.SK_ID_CURR: r for r in bureau.bureau_features(accounts(spark), spark.createDataFrame([], BALANCE)).collect()}
    assert (rows[1].bur_total_accounts, rows[1].bur_active_accounts, rows[1].bur_debt_credit_ratio) == (2, 1, 0.5)
    assert rows[2].bur_debt_credit_ratio is None
    assert rows[1].bur_delinq_rate is None


def test_store_columns_and_signals(spark, small_store):
    assert len(small_store.columns) == 48
    assert len(set(small_store.columns)) == 48
    assert len(store.MODEL_FEATURES) == 38
    assert len(early_warning.BEHAVIOUR_FEATURES) == 21
    assert small_store.where("TARGET IS NULL").count() == 0
    bad = small_store.where("n_products_delinquent NOT BETWEEN 0 AND 3 OR stress_composite IS NULL")
    assert bad.count() == 0


def test_hot_customer_equals_plain_aggregation(spark):
    """A third of all instalments belong to one customer."""
    rows = [(1 if i % 3 == 0 else i, 1, i, -float(i % 400), -float(i % 400) + i % 9, 10.0, float(i % 12)) for i in range(6000)]
    df = spark.createDataFrame(rows, INS).repartition(8)
    r = installments.installment_features(df).where("SK_ID_CURR = 1").first()
    late = [i % 9 for i in range(6000) if i % 3 == 0 or i == 1]
    assert r.ins_total_obs == len(late)
    assert r.ins_days_late_mean == pytest.approx(np.mean(late))


@pytest.fixture
def raw_tables(spark):
    """Three customers: one without a label, one without any history, one with all of it."""

    def frame(name, rows):
        columns = tables.SCHEMAS[name]
        full = [tuple(r.get(c) for c in columns) for r in rows]
        return spark.createDataFrame(full, ", ".join(f"{c} {t}" for c, t in columns.items()))

    def make(**bureau_today):
        account = {
            "SK_ID_CURR": 1, "SK_ID_BUREAU": 10, "CREDIT_ACTIVE": "Active", "CREDIT_DAY_OVERDUE": 3,
            "AMT_CREDIT_SUM_OVERDUE": 5.0, "AMT_CREDIT_SUM": 100.0, "AMT_CREDIT_SUM_DEBT": 40.0, "DAYS_CREDIT": -900,
        }
        return {
            "application": frame("application", [
                {"SK_ID_CURR": 1, "TARGET": 1, "DAYS_BIRTH": -10000, "DAYS_EMPLOYED": -500},
                {"SK_ID_CURR": 2, "TARGET": 0}, {"SK_ID_CURR": 3, "TARGET": None},
            ]),
            "installments": frame("installments", [
                {"SK_ID_CURR": 1, "SK_ID_PREV": 5, "NUM_INSTALMENT_NUMBER": 1, "DAYS_INSTALMENT": -500.0,
                 "DAYS_ENTRY_PAYMENT": -490.0, "AMT_INSTALMENT": 10.0, "AMT_PAYMENT": 10.0},
            ]),
            "card_balance": frame("card_balance", []),
            "bureau": frame("bureau", [{**account, **bureau_today}]),
            "bureau_balance": frame("bureau_balance", [
                {"SK_ID_BUREAU": 10, "MONTHS_BALANCE": -14, "STATUS": "1"},
                {"SK_ID_BUREAU": 99, "MONTHS_BALANCE": -14, "STATUS": "5"},  # of no known account
            ]),
        }

    return make


def test_store_rows_of_odd_customers(raw_tables):
    rows = {r.SK_ID_CURR: r for r in store.feature_store(raw_tables()).collect()}
    assert sorted(rows) == [1, 2]  # no label, no row
    assert rows[1].bur_worst_status_ever == 1 and rows[1].bur_delinq_rate == 1.0
    assert rows[2].bur_total_accounts is None and rows[2].stress_composite == 0.0


def test_earlier_store_does_not_know_today(raw_tables):
    before = store.feature_store(raw_tables(), as_of=12).collect()
    changed = raw_tables(
        CREDIT_ACTIVE="Closed", CREDIT_DAY_OVERDUE=99, AMT_CREDIT_SUM_OVERDUE=1e6, AMT_CREDIT_SUM_DEBT=1e6
    )
    assert store.feature_store(changed, as_of=12).collect() == before
    row = next(r for r in before if r.SK_ID_CURR == 1)
    assert row.app_age_days == -10000 + 360 and row.app_days_employed == -500 + 360
    assert row.bur_total_accounts == 1 and row.bur_active_accounts is None
    assert row.bur_days_credit_min == -900 + 360


def test_history_beside_the_store_changes_nothing_in_it(spark, raw_tables):
    """Also for a customer whose only instalment is outside the base."""
    raw = raw_tables()
    odd = {"SK_ID_CURR": 2, "SK_ID_PREV": 6, "NUM_INSTALMENT_NUMBER": 1, "DAYS_INSTALMENT": -400.0,
           "DAYS_ENTRY_PAYMENT": -390.0, "AMT_INSTALMENT": -1.0, "AMT_PAYMENT": 0.0}
    columns = ", ".join(f"{c} {t}" for c, t in tables.SCHEMAS["installments"].items())
    raw["installments"] = raw["installments"].unionByName(spark.createDataFrame([tuple(odd.values())], columns))
    plain = store.feature_store(raw)
    both = early_warning.store_with_history(raw)
    assert both.select(*plain.columns).exceptAll(plain).count() == 0
    rows = {(r.SK_ID_CURR, r.months_before_default): r for r in early_warning.snapshot_features(both).collect()}
    assert rows[2, 12].ins_days_late_mean == 10.0 and rows[2, 12].ins_pct_missed == 1.0
    assert rows[1, 12].ins_days_late_mean == 10.0 and len(rows) == 10
