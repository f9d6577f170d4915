import random

import pytest
from arrears.operators import early_warning, history, store
from arrears.sources import tables

MONTHS = [12, 9, 6, 3, 1]


def frame(spark, name, rows):
    schema = tables.SCHEMAS[name]
    text = ", ".join(f"{c} {t}" for c, t in schema.items())
    return spark.createDataFrame([tuple(r.get(c) for c in schema) for r in rows], text)


@pytest.fixture(scope="module")
def raw(spark):
    """Random histories with edges on and beside every window, nulls and unknown payments."""
    rng = random.Random(4)
    edges = [-30 * m - w + d for m in (0, *MONTHS) for w in (0, 91, 182) for d in (-1, 0, 1)]

    def maybe(value, share=0.1):
        return None if rng.random() < share else value

    due = [*edges, *[rng.randint(-900, 40) for _ in range(500)]]
    paid = [
        {
            "SK_ID_CURR": rng.randint(1, 12), "SK_ID_PREV": i, "NUM_INSTALMENT_NUMBER": i,
            "DAYS_INSTALMENT": float(d), "DAYS_ENTRY_PAYMENT": maybe(float(d + rng.choice([-40, -3, 0, 5, 70]))),
            "AMT_INSTALMENT": maybe(rng.choice([0.0, 50.0, 80.5, -1.0]), 0.05),
            "AMT_PAYMENT": maybe(rng.choice([0.0, 25.0, 80.5, 200.0])),
        }
        for i, d in enumerate(due)
    ]
    months = [
        {
            "SK_ID_CURR": rng.randint(1, 12), "MONTHS_BALANCE": -rng.randint(0, 30),
            "AMT_BALANCE": maybe(rng.uniform(-5, 900)), "AMT_CREDIT_LIMIT_ACTUAL": maybe(rng.choice([0.0, 300.0])),
            "AMT_PAYMENT_CURRENT": maybe(rng.uniform(0, 90)), "AMT_INST_MIN_REGULARITY": rng.choice([0.0, 30.0]),
            "AMT_DRAWINGS_CURRENT": maybe(rng.uniform(0, 50)), "SK_DPD": maybe(rng.randint(0, 40)),
        }
        for _ in range(300)
    ]
    accounts = [
        {
            "SK_ID_CURR": rng.randint(1, 12), "SK_ID_BUREAU": i, "CREDIT_ACTIVE": rng.choice(["Active", "Closed"]),
            "CREDIT_DAY_OVERDUE": maybe(rng.randint(0, 9)), "AMT_CREDIT_SUM_OVERDUE": maybe(rng.uniform(0, 9)),
            "AMT_CREDIT_SUM": maybe(rng.uniform(0, 900)), "AMT_CREDIT_SUM_DEBT": maybe(rng.uniform(0, 90)),
            "DAYS_CREDIT": maybe(rng.choice([-360, -359, -361, -30, -29, 5, -1000])),
        }
        for i in range(60)
    ]
    status = [
        {"SK_ID_BUREAU": rng.randint(0, 63), "MONTHS_BALANCE": -rng.randint(0, 30), "STATUS": rng.choice("012345CXZ")}
        for _ in range(600)
    ]
    people = [
        {"SK_ID_CURR": i, "TARGET": maybe(i % 2), "AMT_CREDIT": 10.0 * i, "DAYS_BIRTH": -9000 - i, "DAYS_EMPLOYED": -400}
        for i in range(1, 15)
    ]
    return {
        "application": frame(spark, "application", people),
        "installments": frame(spark, "installments", paid),
        "card_balance": frame(spark, "card_balance", months),
        "bureau": frame(spark, "bureau", accounts),
        "bureau_balance": frame(spark, "bureau_balance", status),
    }


def comparable(row):
    return {k: round(v, 8) if isinstance(v, float) else v for k, v in row.asDict().items()}


@pytest.mark.parametrize("months", [MONTHS, [0, 3], [7]])
def test_every_month_is_the_store_of_that_month(raw, months):
    merged = history.store_as_of_months(raw, months)
    found = {(r.SK_ID_CURR, r[history.MONTH]): comparable(r) for r in merged.collect()}
    kinds = {f.name: f.dataType for f in merged.schema}
    for m in months:
        single = store.feature_store(raw, as_of=m)
        assert {f.name: f.dataType for f in single.schema}.items() <= kinds.items()
        rows = single.collect()
        for r in rows:
            assert found[r.SK_ID_CURR, m] == comparable(r) | {history.MONTH: m}
    assert len(found) == len(rows) * len(months)


def test_raw_tables_are_read_once_and_only_cells_are_shuffled(spark, raw, folder):
    on_disk = {}
    for name, df in raw.items():
        df.write.parquet(f"{folder}/{name}")
        on_disk[name] = spark.read.parquet(f"{folder}/{name}")
    plan = history.store_as_of_months(on_disk)._jdf.queryExecution().executedPlan().toString()
    for name in ("installments", "card_balance", "bureau_balance"):
        assert plan.count(f"{folder}/{name}]") == 1
        assert not [line for line in plan.splitlines() if "Exchange" in line and "AMT_PAYMENT#" in line]


def test_lead_times_on_the_store_of_each_month(raw):
    seen = early_warning.align_features(history.store_as_of_months(raw, [12, 1]))
    rows = early_warning.lead_time(seen.withColumn("score", seen["ins_pct_late"])).collect()
    assert [r.months_before_default for r in rows] == [12, 1]


@pytest.mark.parametrize("months", [[], [-1, 3]])
def test_months_are_needed(raw, months):
    with pytest.raises(ValueError):
        history.store_as_of_months(raw, months)
