import re

import pytest
from arrears.operators import store
from arrears.sources import buckets, tpch
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def raw(spark):
    from arrears.sources.staging import stage

    return {name: stage(df) for name, df in tpch.tables(spark, SMALL).items()}


@pytest.fixture
def joins_by_key(spark):
    """No broadcasts, as for large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def test_the_store_needs_no_shuffle_of_what_is_kept_by_its_key(spark, raw, folder, joins_by_key):
    buckets.write_bucketed(raw, folder)
    kept = store.feature_store(buckets.read_bucketed(spark, folder))
    plain = store.feature_store(raw)
    # Accounts are kept by account; what they add up to still moves to its customer.
    assert exchanges(kept) == ["SK_ID_CURR", "SK_ID_CURR"]
    assert len(exchanges(plain)) > 5
    rounded = [
        sorted(str([round(v, 8) if isinstance(v, float) else v for v in r]) for r in df.collect())
        for df in (kept, plain)
    ]
    assert rounded[0] == rounded[1]


def test_rows_and_types_survive(spark, raw, folder):
    buckets.write_bucketed(raw, folder, 3)
    for name, df in buckets.read_bucketed(spark, folder).items():
        assert df.schema.simpleString() == raw[name].schema.simpleString()
        assert df.exceptAll(raw[name]).count() == 0 and df.count() == raw[name].count()


def test_written_again_with_other_buckets(spark, raw, folder):
    one = {"bureau": raw["bureau"]}
    buckets.write_bucketed(one, folder, 3)
    buckets.write_bucketed({"bureau": raw["bureau"].limit(5)}, folder, 2)
    assert buckets.read_bucketed(spark, folder, ["bureau"])["bureau"].count() == 5
