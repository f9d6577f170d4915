from decimal import Decimal

import numpy as np
import pytest
from arrears.functions import ordering
from arrears.functions.columns import clip
from arrears.functions.ordering import exact_quantiles, first_in_order, number_in_order
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one sort value, and one group holds most rows."""
    rows = [
        (i, 0.5 if i % 3 == 0 else float((i * 7919) % 1000) / 1000, "a" if i % 10 else "b", i % 5)
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "id bigint, v double, g string, w int")


@pytest.fixture(params=["as set", "too narrow"])
def brackets(request, monkeypatch):
    """Brackets that hold their quantiles, and first ones that miss and must be widened."""
    if request.param == "too narrow":
        real = ordering._bracketed_quantiles

        def missing(present, value, shares, by, bracket):
            found = real(present, value, shares, by, bracket)
            if bracket == ordering.BRACKETS[-1]:
                return found
            return found.withColumn("q0", F.when(F.lit(False), F.col("q0")))

        monkeypatch.setattr(ordering, "_bracketed_quantiles", missing)


def expected_positions(rows, by_group):
    out, seen, total = {}, {}, {}
    for r in sorted(rows, key=lambda r: (-r.v, r.id)):
        g = r.g if by_group else None
        seen[g] = seen.get(g, 0) + 1
        total[g] = total.get(g, 0) + r.w
        out[r.id] = (seen[g], total[g])
    return out


@pytest.mark.parametrize("by", [[], ["g"]])
def test_positions_and_totals(skewed, by):
    got = number_in_order(skewed, [F.desc("v"), F.col("id")], totals={"upto": "w"}, by=by).collect()
    want = expected_positions(skewed.collect(), bool(by))
    assert {r.id: (r.position, r.upto) for r in got} == want


def test_repeated_value_is_spread_over_slices(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    kept = []
    real = ordering.stage
    monkeypatch.setattr(ordering, "stage", lambda df: kept.append(real(df)) or kept[-1])
    rows = [(i, 0.5 if i % 3 == 0 else i / 3000) for i in range(3000)]
    number_in_order(spark.createDataFrame(rows, "id bigint, v double"), [F.desc("v"), F.col("id")])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(kept) == 2  # the numbered rows and their shifts
    sizes = [r["count"] for r in kept[0].groupBy("_slice").count().collect()]
    assert sum(sizes) == 3000
    assert max(sizes) < 2.5 * 3000 / 8


def test_null_groups_and_doubles(spark):
    rows = [(i, None if i % 4 == 0 else "ab"[i % 2], None if i % 5 == 0 else i / 7) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, g string, w double").repartition(7)
    found = number_in_order(df, [F.col("id")], totals={"upto": "w"}, by=["g"]).collect()
    seen = {}
    for r in sorted(found, key=lambda r: r.id):
        n, total = seen.get(r.g, (0, 0.0))
        seen[r.g] = (n + 1, total + (r.w or 0.0))
        assert (r.position, r.upto) == (seen[r.g][0], pytest.approx(seen[r.g][1]))
    assert len(found) == 500


def test_totals_of_decimals_are_exact(spark):
    df = spark.range(9).selectExpr("id", "CAST(IF(id = 4, NULL, id + 0.75) AS DECIMAL(12,2)) AS m", "id AS w")
    found = number_in_order(df.repartition(3), [F.col("id")], totals={"upto": "m", "n": "w"}).collect()
    total, n = Decimal("0.00"), 0
    for r in sorted(found, key=lambda r: r.id):
        total, n = total + (r.m or 0), n + r.w
        assert (r.upto, r.n) == (total, n)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_equal_numpy(skewed, brackets, by):
    shares = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    with_nulls = skewed.withColumn("v", F.when(F.col("id") % 7 != 0, F.col("v")))
    found = exact_quantiles(with_nulls, "v", shares, by).collect()
    rows = with_nulls.where("v IS NOT NULL").collect()
    for r in found:
        values = [x.v for x in rows if not by or x.g == r.g]
        assert np.allclose([r[f"q{i}"] for i in range(len(shares))], np.quantile(values, shares), atol=1e-12)


def test_brackets_narrow_a_wide_table(spark, monkeypatch):
    """Many distinct values: quantiles come from the few inside the brackets."""
    rng = np.random.default_rng(11)
    values = np.round(rng.lognormal(3, 2, 40_000), 4)
    values[::3] = 17.5
    df = spark.createDataFrame([(float(v), "ab"[i % 2]) for i, v in enumerate(values)], "v double, g string")
    sorted_rows = []
    real = ordering.number_in_order
    monkeypatch.setattr(
        ordering, "number_in_order", lambda d, *a, **k: sorted_rows.append(d.count()) or real(d, *a, **k)
    )
    shares = [0.01, 0.1, 0.5, 0.9, 0.99]
    for r in exact_quantiles(df, "v", shares, ["g"]).collect():
        own = values["ab".index(r.g) :: 2]
        assert np.allclose([r[f"q{i}"] for i in range(5)], np.quantile(own, shares), rtol=1e-12)
    assert len(sorted_rows) == 1 and sorted_rows[0] < 1000


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id bigint, v double")
    assert number_in_order(empty, [F.col("v"), F.col("id")]).count() == 0
    assert exact_quantiles(empty, "v", [0.5]).first().q0 is None


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (3.0,), (None,)], "v double")
    got = [r.c for r in df.select(clip(F.col("v"), F.lit(0.0), F.lit(1.0)).alias("c")).collect()]
    assert got == [0.0, 0.5, 1.0, None]


def first_rows(df, n, key_level=True):
    """First rows by v falling and by w, with ids deciding."""
    levels = [F.col("id")] if key_level else []
    orders = {
        "v": ([-F.col("v"), F.col("id")], [-F.col("v"), *levels]),
        "w": ([F.col("w").cast("double"), F.col("id")], [F.col("w"), *levels]),
    }
    return first_in_order(df, orders, n, "order", {"upto": "w"})


@pytest.mark.parametrize("n,one_task", [(1, 50_000), (7, 0), (1000, 0), (1000, 50_000), (2999, 0), (5000, 50_000)])
@pytest.mark.parametrize("key_level", [True, False])
def test_first_rows_of_several_orders(skewed, monkeypatch, n, one_task, key_level):
    monkeypatch.setattr(ordering, "ONE_TASK", one_task)
    found = first_rows(skewed, n, key_level).collect()
    rows = skewed.collect()
    for order, key in (("v", lambda r: (-r.v, r.id)), ("w", lambda r: (r.w, r.id))):
        total = 0
        own = sorted((r for r in found if r.order == order), key=lambda r: r.position)
        for place, (got, want) in enumerate(zip(own, sorted(rows, key=key)[:n], strict=True), 1):
            total += want.w
            assert (got.position, got.id, got.upto) == (place, want.id, total)


def test_only_the_first_rows_are_put_in_order(skewed, monkeypatch):
    sorted_rows = []
    real = ordering.number_in_order
    monkeypatch.setattr(ordering, "ONE_TASK", 0)
    monkeypatch.setattr(
        ordering, "number_in_order", lambda d, *a, **k: sorted_rows.append(d.count()) or real(d, *a, **k)
    )
    assert first_rows(skewed, 20).count() == 40
    assert sorted_rows == [40]  # although a fifth of the rows share the lowest w


def test_first_rows_with_nulls_and_nan(spark):
    values = [3.0, None, float("nan"), 1.0, float("inf"), None, -2.0]
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v double")
    found = first_in_order(df, {"v": ([F.col("v"), F.col("id")], [F.col("v"), F.col("id")])}, 6, "o").collect()
    assert [r.id for r in sorted(found, key=lambda r: r.position)] == [6, 3, 0, 4, 2, 1]
    empty = df.where("id < 0")
    assert first_in_order(empty, {"v": ([F.col("v"), F.col("id")], [F.col("v")])}, 6, "o").count() == 0
