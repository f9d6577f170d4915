import numpy as np
import pytest
from arrears.operators import metrics
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def scored(spark):
    """Scores with ties; a third of the rows share one score."""
    rng = np.random.default_rng(3)
    score = np.round(rng.random(1503), 2)
    score[::3] = 0.4
    label = (rng.random(1503) < score).astype(int)
    rows = [(i, float(score[i]), int(label[i]), bool(i % 10 < 7)) for i in range(1503)]
    return spark.createDataFrame(rows, "SK_ID_CURR bigint, score double, label int, is_train boolean")


def test_auc_equals_the_evaluator(scored):
    found = metrics.rank_metrics(metrics.ranked_scores(scored)).first()
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert found.auc == pytest.approx(evaluator.evaluate(scored), abs=1e-12)
    assert found.gini == pytest.approx(2 * found.auc - 1)


def test_ks_at_distinct_scores(scored):
    rows = scored.collect()
    bad = sum(r.label for r in rows)
    good = len(rows) - bad
    want = max(
        abs(sum(r.label for r in rows if r.score >= s) / bad - sum(1 - r.label for r in rows if r.score >= s) / good)
        for s in {r.score for r in rows}
    )
    ranked = metrics.ranked_scores(scored)
    assert metrics.rank_metrics(ranked).first().ks == pytest.approx(want)
    assert metrics.ks_position(ranked).first().ks == pytest.approx(want)


def test_roc_ends_at_one(scored):
    last = metrics.roc_points(metrics.ranked_scores(scored)).orderBy("score").first()
    assert (last.fpr, last.tpr) == (1.0, 1.0)


def test_psi_worked_out_by_hand(spark):
    """Quartiles of 1..8 are 2.75, 4.5 and 6.25; a value on a limit belongs above it."""
    train = [1, 2, 3, 4, 5, 6, 7, 8]  # 2 of 8 in each bin
    test = [0, 1, 2, 2, 2.7, 2.75, 3, 5, 6, 6.25, 8, 9]  # 5, 2, 2 and 3 of 12
    rows = [(float(v), True) for v in train] + [(float(v), False) for v in test]
    bins = metrics.psi_bins(spark.createDataFrame(rows, "score double, is_train boolean"), bins=4)
    listed = [tuple(r) for r in bins.orderBy("bin").collect()]
    assert listed == [
        (0, None, 2.75, 0.25, 5 / 12),
        (1, 2.75, 4.5, 0.25, 2 / 12),
        (2, 4.5, 6.25, 0.25, 2 / 12),
        (3, 6.25, None, 0.25, 3 / 12),
    ]
    # 1/6 ln 5/3 + 2 (-1/12) ln 2/3 + 0
    assert metrics.psi(bins).first().psi == pytest.approx(0.152715122, abs=1e-8)


def test_psi_of_very_many_segments(spark):
    """Limits, counts and totals of 100,000 groups are joined by key, none is collected."""
    df = spark.range(400_000).selectExpr(
        "id % 100000 AS g", "CAST(id AS DOUBLE) AS score", "id < 300000 AS is_train"
    )
    found = metrics.psi(metrics.psi_bins(df, ["g"], bins=2), ["g"])
    row = found.agg(F.count(F.lit(1)).alias("n"), F.min("psi").alias("low"), F.max("psi").alias("high")).first()
    # Train 1/3 below the middle one and 2/3 from it on; test has its one row above.
    by_hand = (1e-6 - 1 / 3) * np.log(3e-6) + (1 - 2 / 3) * np.log(1.5)
    assert row.n == 100_000
    assert row.low == pytest.approx(by_hand) and row.high == pytest.approx(by_hand)


def test_psi_of_the_same_sample_is_zero(scored):
    both = scored.withColumn("is_train", F.lit(True)).unionByName(scored.withColumn("is_train", F.lit(False)))
    assert metrics.psi(metrics.psi_bins(both)).first().psi == pytest.approx(0.0, abs=1e-12)


def test_psi_lists_empty_bins(spark):
    rows = [(float(i), True) for i in range(100)] + [(0.0, False)]
    bins = metrics.psi_bins(spark.createDataFrame(rows, "score double, is_train boolean")).collect()
    assert len(bins) == 10
    assert sum(b.actual_share == 1e-6 for b in bins) == 9


def test_psi_status(spark):
    df = spark.createDataFrame([(0.09,), (0.10,), (0.25,)], "p double")
    assert [r[0] for r in df.select(metrics.psi_status(F.col("p"))).collect()] == ["stable", "watch", "alert"]


@pytest.mark.parametrize("n", [21, 1503])
def test_gain_curve_bins(spark, scored, n):
    rows = sorted(scored.where(F.col("SK_ID_CURR") < n).collect(), key=lambda r: (-r.score, r.SK_ID_CURR))
    found = metrics.gain_curve(scored.where(F.col("SK_ID_CURR") < n)).orderBy("pct_pop").collect()
    total = sum(r.label for r in rows)
    bins = [max(int(np.ceil((i * 20) / (n - 1))) - 1, 0) for i in range(n)]
    want = np.cumsum([sum(r.label for r, b in zip(rows, bins, strict=True) if b == k) for k in range(20)]) / total
    assert [r.cum_bad_rate for r in found] == pytest.approx(list(want))
    assert found[-1].cum_bad_rate == 1.0


def test_model_gain_over_baseline(scored):
    better = scored.select("SK_ID_CURR", "label", "is_train", F.col("label").cast("double").alias("score"))
    both = scored.withColumn("model", F.lit("A")).unionByName(better.withColumn("model", F.lit("B")))
    found = {r.model: r for r in metrics.model_comparison(both, "A").collect()}
    assert found["A"].auc_gain == 0.0
    assert found["B"].auc == 1.0
    assert found["B"].auc_gain == pytest.approx(1.0 - found["A"].auc)


def test_fit_checks(spark):
    df = spark.createDataFrame([("train", 0.80), ("test", 0.60)], "sample string, auc double")
    r = metrics.fit_checks(df).first()
    assert (r.overfit, r.weak_model) == (True, True)
