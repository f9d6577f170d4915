import math

import numpy as np
import pytest
from arrears.functions import counting
from arrears.functions.counting import counted_quantiles, values_at

SHARES = [0.0, 0.01, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]


@pytest.fixture(scope="module")
def wide(spark):
    """Columns of different shapes: ties, signs, wide ranges, nulls, constants, nothing."""
    rng = np.random.default_rng(8)
    n = 6000
    columns = {
        "ties": rng.integers(-3, 4, n).astype(float),
        "normal": rng.normal(size=n),
        "wide": np.exp(rng.normal(size=n) * 60) * rng.choice([-1, 1], n),
        "third": np.where(np.arange(n) % 3 == 0, 0.5, rng.random(n)),
        "constant": np.full(n, -0.0),
        "nothing": np.full(n, np.nan),
    }
    rows = [
        (int(i % 7), None if i % 5 == 0 else "ab"[i % 2],
         *[None if name == "nothing" or (name == "normal" and i % 4 == 0) else float(c[i]) for name, c in columns.items()])
        for i in range(n)
    ]
    schema = "w int, g string, " + ", ".join(f"{c} double" for c in columns)
    return list(columns), spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(params=[2048, 3])
def few(request, monkeypatch):
    """Intervals whose values are listed early, or narrowed to the last bit."""
    monkeypatch.setattr(counting, "FEW", request.param)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_equal_numpy(wide, few, by):
    columns, df = wide
    rows = df.collect()
    found = counted_quantiles(df, columns, SHARES, by).collect()
    assert len(found) == len(columns) * (3 if by else 1)
    for r in found:
        values = [x[r.column] for x in rows if x[r.column] is not None and (not by or x.g == r.g)]
        got = [r[f"q{i}"] for i in range(len(SHARES))]
        if values:
            assert np.allclose(got, np.quantile(values, SHARES), rtol=1e-12, atol=0)
        else:
            assert got == [None] * len(SHARES)


def test_places_count_what_is_below(wide, few):
    columns, df = wide
    values = sorted(r.third for r in df.collect())
    total, places = values_at(df, ["third"], lambda _, n: [0, n // 2, n - 1])[(), "third"]
    assert total == len(values)
    for rank, place in places.items():
        assert place.value == values[rank]
        assert place.below == sum(v < place.value for v in values)
        assert place.upto == sum(v <= place.value for v in values)


def test_odd_numbers_keep_their_order(spark):
    values = [math.nan, math.inf, -math.inf, 0.0, -0.0, 5e-324, -5e-324, 1.7e308, 2**53 + 2.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    total, places = values_at(df, ["v"], lambda _, n: range(n))[(), "v"]
    ordered = [-math.inf, -5e-324, 0.0, 0.0, 5e-324, 2**53 + 2.0, 1.7e308, math.inf]
    assert total == 9 and [places[i].value for i in range(8)] == ordered
    assert math.isnan(places[8].value)


def test_what_is_shuffled_does_not_follow_the_rows(spark):
    """Tasks pass on no more rows for ten times the values."""
    passed = []
    real = counting._counts

    def watched(*args):
        passed.append(real(*args))
        return passed[-1]

    for n in (20_000, 200_000):
        df = spark.range(n, numPartitions=4).selectExpr("CAST(hash(id) AS DOUBLE) AS v")
        passed.clear()
        counting._counts = watched
        try:
            values_at(df, ["v"], lambda _, n: [n // 2])
        finally:
            counting._counts = real
        assert len(passed) <= 4 and all(len(rows) <= 2 * counting.CELLS for rows in passed)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "v double, g string")
    assert counted_quantiles(empty, ["v"], [0.5]).first().q0 is None
    assert counted_quantiles(empty, ["v"], [0.5], ["g"]).count() == 0
    assert values_at(empty, ["v"], lambda _, n: range(n)) == {}
