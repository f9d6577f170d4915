from itertools import combinations

import numpy as np
import pytest
from arrears.operators import binning, quality, scorecard, split
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F


def trend_of(rate, turns):
    """Whether the rates rise or fall throughout, or with one turn if that is allowed."""
    steps = [step for step in np.diff(rate) if step != 0]
    changes = sum(a * b < 0 for a, b in zip(steps, steps[1:], strict=False))
    return changes <= turns


def brute_force(rows, all_rows, all_bad, max_bins, min_share, turns=0):
    best = -1.0
    size = len(rows)
    for k in range(min(max_bins, size)):
        for cut in combinations(range(1, size), k):
            edges = [0, *cut, size]
            parts = [rows[a:b] for a, b in zip(edges, edges[1:], strict=False)]
            n = [sum(r for r, _ in p) for p in parts]
            b = [sum(x for _, x in p) for p in parts]
            if min(n) <= 0 or min(n) < min_share * all_rows:
                continue
            rate = np.array(b) / np.array(n)
            if not trend_of(rate, turns):
                continue
            iv = sum(
                binning.smoothed_woe(ni - bi, bi, all_rows - all_bad, all_bad)[1]
                for ni, bi in zip(n, b, strict=True)
            )
            best = max(best, iv)
    return best


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 60), st.floats(0, 1)), min_size=1, max_size=8),
    st.integers(1, 5),
    st.integers(0, 1),
)
def test_grouping_is_the_best_admissible_one(cells, max_bins, turns):
    rows = [(n, round(n * share)) for n, share in cells]
    all_rows, all_bad = sum(n for n, _ in rows), sum(b for _, b in rows)
    ranges = binning.best_grouping(rows, all_rows, all_bad, max_bins, 0.1, turns)
    assert [a for a, _ in ranges] == [0, *[b for _, b in ranges[:-1]]]
    assert ranges[-1][1] == len(rows)
    total = sum(
        binning.smoothed_woe(
            sum(n - b for n, b in rows[i:j]), sum(b for _, b in rows[i:j]), all_rows - all_bad, all_bad
        )[1]
        for i, j in ranges
    )
    assert total == pytest.approx(brute_force(rows, all_rows, all_bad, max_bins, 0.1, turns), abs=1e-9)


def plain_tree(cells, max_leaves, least):
    """Leaves by trying every cut of every leaf again and again."""
    leaves = [(0, len(cells))]

    def impurity(start, end):
        n, b = (sum(c[k] for c in cells[start:end]) for k in (0, 1))
        return b * (n - b) / n if n else 0.0

    while len(leaves) < max_leaves:
        found = []
        for start, end in leaves:
            for at in range(start + 1, end):
                sizes = [sum(n for n, _ in cells[a:b]) for a, b in ((start, at), (at, end))]
                gain = round(impurity(start, end) - impurity(start, at) - impurity(at, end), 9)
                if min(sizes) >= least and gain > 0:
                    found.append((-gain, start, end, at))
        if not found:
            break
        _, start, end, at = min(found, key=lambda f: (f[0], f[1], f[2], f[3]))
        leaves.remove((start, end))
        leaves += [(start, at), (at, end)]
    return sorted(leaves)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.floats(0, 1)), min_size=1, max_size=25), st.integers(1, 8))
def test_tree_takes_the_best_cut_each_time(cells, max_leaves):
    rows = [(n, round(n * share)) for n, share in cells]
    least = max(0.05 * sum(n for n, _ in rows), 1)
    assert binning.tree_grouping(rows, max_leaves) == plain_tree(rows, max_leaves, least)


def test_leaves_hold_their_share_and_lose_no_information(planted):
    """Against the bins that plain quantiles gave before."""
    features = [f"f{j}" for j in range(5)]
    fine = binning.prebin_cuts(planted, features, binning.FINE_CELLS)
    leaves = binning.tree_bins(binning.bin_counts(planted, fine), fine).collect()
    for f in features:
        own = [b.n for b in leaves if b.feature == f and b.bin >= 0]
        assert len(own) <= 20 and min(own) >= 0.05 * sum(own)
    coarse = binning.prebin_cuts(planted, features)

    def quantiles(cells, all_rows, all_bad):
        return binning.best_grouping(cells, all_rows, all_bad, 10, 0.05)

    before = binning.grouped_bins(binning.bin_counts(planted, coarse), coarse, quantiles)
    old = {r.feature: r.IV for r in binning.information_values(binning.woe_table(before)).collect()}
    new = {r.feature: r.IV for r in binning.information_values(binning.optimal_bins(planted, features)).collect()}
    assert new["f0"] >= old["f0"]
    assert sum(new.values()) >= sum(old.values())


def test_a_valley_keeps_its_information(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=8000)
    y = rng.random(8000) < 1 / (1 + np.exp(-(1.5 * x * x - 2)))
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y, strict=True)], "x double, TARGET int")
    cuts = binning.prebin_cuts(df, ["x"])
    fine = binning.information_values(binning.woe_table(binning.bin_counts(df, cuts))).first().IV
    turning = binning.optimal_bins(df, ["x"], turns=1)
    assert binning.information_values(turning).first().IV >= 0.8 * fine
    assert binning.information_values(binning.optimal_bins(df, ["x"])).first().IV < 0.6 * fine
    rates = [b.bad / b.n for b in turning.orderBy("bin").collect()]
    assert trend_of(rates, 1) and not trend_of(rates, 0)


def test_merged_bins_hold_the_constraints(planted):
    features = [f"f{j}" for j in range(5)]
    bins = binning.optimal_bins(planted, features).collect()
    for f in features:
        own = sorted((b for b in bins if b.feature == f and b.bin >= 0), key=lambda b: b.bin)
        assert len(own) <= 10
        assert min(b.n for b in own) >= 0.05 * 6000
        rates = np.diff([b.bad / b.n for b in own])
        assert np.all(rates >= 0) or np.all(rates <= 0)
        assert own[0].low is None and own[-1].high is None
        assert sum(b.n for b in bins if b.feature == f) == 6000
    ivs = {}
    for b in bins:
        ivs[b.feature] = ivs.get(b.feature, 0) + b.iv
    assert max(ivs, key=ivs.get) == "f0"


def test_all_null_feature_is_left_out(spark, planted):
    with_empty = planted.withColumn("nothing", F.lit(None).cast("double"))
    assert list(binning.prebin_cuts(with_empty, ["f0", "nothing"])) == ["f0"]


def test_one_hot_value_stays_whole(spark):
    rows = [(1, 7.0 if i % 3 else float(i), i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, x double, TARGET int")
    counts = binning.bin_counts(df, binning.prebin_cuts(df, ["x"])).collect()
    assert sum(r.n for r in counts) == 900
    assert max(r.n for r in counts) >= 600


def test_missing_and_open_ends_in_the_expression(spark):
    bins = [Row(bin=-1, low=None, high=None, woe=9.0), Row(bin=0, low=None, high=1.0, woe=0.5), Row(bin=1, low=1.0, high=None, woe=-0.25)]
    df = spark.createDataFrame([(None,), (0.0,), (1.0,), (50.0,)], "x double")
    got = [r.w for r in df.select(F.expr(binning.woe_expression("x", bins)).alias("w")).collect()]
    assert got == [0.0, 0.5, -0.25, -0.25]


def test_fallback_selection(spark):
    ivs = spark.createDataFrame([("a", 0.01), ("b", 0.006), ("c", 0.001)], "feature string, IV double")
    assert {r.feature for r in binning.select_by_iv(ivs).collect()} == {"a", "b"}
    more = ivs.union(spark.createDataFrame([("d", 0.02)], ivs.schema))
    assert {r.feature for r in binning.select_by_iv(more).collect()} == {"d"}


def test_features_below_both_bars_still_make_a_scorecard(spark):
    """Features that hardly tell the classes apart, as on tables with many rows, are all taken."""
    rows = [
        (i, i % 2, 1.0 if i % 80 == 0 else float(i // 2 % 2), 1.0 if i % 100 == 0 else float(i // 4 % 2), 1.0)
        for i in range(4000)
    ]
    train = spark.createDataFrame(rows, "SK_ID_CURR bigint, TARGET int, a double, b double, c double")
    ivs = binning.information_values(binning.optimal_bins(train, ["a", "b", "c"], turns=1))
    assert binning.select_by_iv(ivs).count() == 0
    wanted = [r.feature for r in ivs.collect() if r.IV > 0]
    model, _, selected = scorecard.fit_scorecard(train, ["a", "b", "c"])
    assert selected == wanted and selected and "c" not in selected
    assert len(model.stages[-1].coefficients) == len(selected)


def newton(x, y, w, c):
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x1.shape[1])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ beta))
        grad = c * x1.T @ (w * (p - y)) + penalty @ beta
        hess = c * (x1 * (w * p * (1 - p))[:, None]).T @ x1 + penalty
        beta -= np.linalg.solve(hess, grad)
    return beta


def test_coefficients_equal_a_newton_solve(spark, planted):
    model, bins, selected = scorecard.fit_scorecard(planted, [f"f{j}" for j in range(5)])
    assert selected[0] == "f0"
    data = model.transform(scorecard.balanced_weights(planted)).toPandas()
    x = np.vstack([v.toArray() for v in data["features"]])
    want = newton(x, data["TARGET"].to_numpy(), data["weight"].to_numpy(), 0.1)
    fitted = model.stages[-1]
    assert np.allclose([*fitted.coefficients, fitted.intercept], want, atol=1e-4)


def test_balanced_weights_sum(planted):
    sums = {r.TARGET: r.w for r in scorecard.balanced_weights(planted).groupBy("TARGET").agg(F.sum("weight").alias("w")).collect()}
    assert sums[0] == pytest.approx(3000)
    assert sums[1] == pytest.approx(3000)


def test_cross_validation_finds_the_signal(planted):
    bins, selected = scorecard.informative_bins(planted, [f"f{j}" for j in range(5)])
    mean, deviation = scorecard.cross_validated_auc(planted, binning.woe_expressions(bins, selected))
    assert mean > 0.7
    assert deviation < 0.1


def test_folds_models_equal_single_fits(spark, planted):
    """Against a Newton solve of each fold on its own, and the AUC by comparing all pairs."""
    bins, selected = scorecard.informative_bins(planted, [f"f{j}" for j in range(5)])
    expressions = binning.woe_expressions(bins, selected)
    scored = scorecard.cross_validated_scores(planted, expressions).toPandas()
    woe = planted.select("SK_ID_CURR", *[F.expr(e).alias(f"x{i}") for i, e in enumerate(expressions.values())])
    data = woe.toPandas().merge(scored, on="SK_ID_CURR")
    x, y, fold = data.filter(regex="^x").to_numpy(), data["TARGET"].to_numpy(), data["fold"].to_numpy()
    aucs = []
    for m in range(5):
        seen, own = fold != m, fold == m
        counts = np.bincount(y[seen], minlength=2)
        beta = newton(x[seen], y[seen], (seen.sum() / (2 * counts))[y[seen]], 0.1)
        want = 1 / (1 + np.exp(-(x[own] @ beta[:-1] + beta[-1])))
        assert np.allclose(data["score"][own], want, atol=1e-8)
        bad, good = data["score"][own & (y == 1)].to_numpy(), data["score"][own & (y == 0)].to_numpy()
        aucs.append(np.mean((bad[:, None] > good) + 0.5 * (bad[:, None] == good)))
    mean, deviation = scorecard.cross_validated_auc(planted, expressions)
    assert (mean, deviation) == pytest.approx((np.mean(aucs), np.std(aucs)), abs=1e-9)


def test_points_anchor(spark):
    woe = spark.createDataFrame([("a", 0, None, None, 0.0, 0.0), ("b", 0, None, None, 0.0, 0.0)], "feature string, bin int, low double, high double, woe double, iv double")
    coefs = spark.createDataFrame([("a", -1.0), ("b", -1.0)], "feature string, coef double")
    plain = scorecard.points_table(woe, coefs, 0.0).collect()
    anchored = scorecard.points_table(woe, coefs, 0.0, anchor=True).collect()
    assert [r.points for r in plain] == [0.0, 0.0]
    assert sum(r.points for r in anchored) == 600.0


def test_split_is_stratified_and_stable(planted):
    first = split.stratified_split(planted)
    share = {r.TARGET: r.s for r in first.groupBy("TARGET").agg(F.avg(F.col("is_train").cast("int")).alias("s")).collect()}
    assert share[0] == pytest.approx(0.7, abs=0.001)
    assert share[1] == pytest.approx(0.7, abs=0.001)
    again = split.stratified_split(planted.repartition(3))
    assert first.select("SK_ID_CURR", "is_train").exceptAll(again.select("SK_ID_CURR", "is_train")).count() == 0


def test_constant_feature_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, float(i), i % 2) for i in range(10)], "a double, b double, TARGET int")
    got = {(r.feature_1, r.feature_2): r.corr for r in quality.correlation_matrix(df, ["a", "b"]).collect()}
    assert got["a", "TARGET"] is None
    assert got["b", "TARGET"] is not None


def test_folds_keep_the_class_shares(planted):
    dealt = split.folds(planted, 5).groupBy("TARGET", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in dealt if r.TARGET == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_correlation_of_large_numbers(spark):
    rows = [(float(i % 7 + 1e8), float(i % 7 > 3), 0.1, None if i % 3 else float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, TARGET double, c double, d double").repartition(6)
    found = {(r.feature_1, r.feature_2): r["corr"] for r in quality.correlation_matrix(df, ["a", "c", "d"]).collect()}
    small = df.selectExpr("a - 1e8 AS a", "TARGET", "d")
    assert found["a", "TARGET"] == pytest.approx(small.corr("a", "TARGET"), abs=1e-9)
    held = small.where("d IS NOT NULL")
    assert found["a", "d"] == pytest.approx(held.corr("a", "d"), abs=1e-9)
    assert found["a", "c"] is None and found["c", "TARGET"] is None


def test_moments_by_matrix_products(monkeypatch):
    """Equal to each pair on its own; constant, empty and partly constant columns too."""
    rng = np.random.default_rng(9)
    values = rng.normal(size=(400, 7)) * [1, 1e6, 1e-5, 1, 1, 1, 1] + [0, 1e9, 0, 5, 0, 0, 0]
    values[rng.random(values.shape) < 0.3] = np.nan
    values[:, 4] = 0.1
    values[:, 5] = np.nan
    values[~np.isnan(values[:, 0]), 6] = 0.7  # constant beside the first column only
    left, right = (np.array(side) for side in zip(*combinations(range(7), 2), strict=True))
    found = quality._all_moments(values, left, right)
    want = np.array([quality._moments(values[:, a], values[:, b]) for a, b in zip(left, right, strict=True)])
    assert np.allclose(found[:, :3], want[:, :3], rtol=1e-12)
    for part in (3, 4):
        assert np.array_equal(found[:, part] == 0, want[:, part] == 0)

    def corr(moments):
        spread = np.sqrt(moments[:, 3] * moments[:, 4])
        return moments[:, 5] / np.where(spread > 0, spread, 1)

    assert np.allclose(corr(found), corr(want), atol=1e-12)
