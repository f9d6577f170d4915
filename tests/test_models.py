import numpy as np
import pandas as pd
import pytest
from arrears.operators import attribution, challenger, early_warning, metrics, scorecard
from arrears.sources import sinks
from arrears.sources.staging import stage
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

FEATURES = [f"f{j}" for j in range(5)]


@pytest.fixture(scope="module")
def fitted(planted):
    return challenger.fit_boosted_trees(planted, FEATURES, {"maxIter": 6, "maxDepth": 3, "stepSize": 0.3})


def test_trees_find_the_signal(fitted, planted):
    scored = scorecard.probability_of_default(fitted.transform(planted), "score").withColumnRenamed("TARGET", "label")
    assert metrics.rank_metrics(metrics.ranked_scores(scored)).first().auc > 0.75
    importance = fitted.stages[-1].featureImportances.toArray()
    assert int(np.argmax(importance)) == 0


def test_rounds_stop_at_the_highest_validation_auc(planted):
    settings = {"maxIter": 24, "maxDepth": 4, "stepSize": 1.0, "patience": 3}
    stopped = challenger.fit_boosted_trees(planted, FEATURES, settings).stages[-1]
    longer = challenger.fit_boosted_trees(planted, FEATURES, {**settings, "patience": 24}).stages[-1]
    assert 1 <= stopped.getNumTrees < 24  # steps this large soon overfit
    assert stopped.getNumTrees <= longer.getNumTrees <= 24
    first = min(stopped.getNumTrees, longer.getNumTrees)
    assert [t.numNodes for t in stopped.trees[:first]] == [t.numNodes for t in longer.trees[:first]]


def test_kept_trees_equal_a_fit_of_that_length(planted):
    settings = {"maxDepth": 3, "stepSize": 0.3, "patience": 50}
    long = challenger.fit_boosted_trees(planted, FEATURES, {**settings, "maxIter": 7})
    short = challenger.fit_boosted_trees(planted, FEATURES, {**settings, "maxIter": 4})
    count = short.stages[-1].getNumTrees
    kept = challenger.first_trees(long.stages[-1], count)
    assert kept.getNumTrees == count and list(kept.treeWeights) == list(short.stages[-1].treeWeights)
    nodes = lambda m: [t.toDebugString.split("\n")[1:] for t in m.trees]
    assert nodes(kept) == nodes(short.stages[-1])
    inputs = planted
    for transformer in long.stages[:-1]:
        inputs = transformer.transform(inputs)
    ours = scorecard.probability_of_default(kept.transform(inputs)).select("SK_ID_CURR", "PD")
    theirs = scorecard.probability_of_default(short.transform(planted)).select("SK_ID_CURR", "PD")
    assert ours.exceptAll(theirs).count() == 0


def test_patience_looks_at_one_round_after_the_other():
    assert challenger.best_round([0.5, 0.7, 0.6, 0.7, 0.9], 2) == (2, True)  # 0.9 comes too late
    assert challenger.best_round([0.5, 0.7, 0.6, 0.8], 2) == (4, False)
    assert challenger.best_round([0.5], 1) == (1, False)


def test_validation_auc_is_exact_in_one_ordered_shuffle(spark, planted, monkeypatch):
    """Every round's AUC once more by ranks, over many slices; no ordering is staged per round."""
    calls = []
    measure = challenger.staged_auc

    def record(validation, blocks, step, label):
        found = measure(validation, blocks, step, label)
        calls.append((validation, blocks, step, label, found))
        return found

    monkeypatch.setattr(challenger, "staged_auc", record)
    staged = []
    monkeypatch.setattr(challenger, "stage", lambda df: staged.append(df.columns) or stage(df))
    settings = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3, "block": 3, "patience": 50}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many slices
    try:
        challenger.fit_boosted_trees(planted, FEATURES, settings)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(staged) == 1 + len(calls)  # the vectors, and the leaves of each measurement
    (validation, blocks, step, label, found) = calls[0]
    rows = validation
    for number, (forest, _) in enumerate(blocks):
        rows = forest.setLeafCol(f"l{number}").transform(rows).drop("_forest")
    pdf = rows.select(label, "margin", *[vector_to_array(f"l{n}").alias(f"l{n}") for n in range(len(blocks))]).toPandas()
    y, margin, at = pdf[label].to_numpy(), pdf["margin"].to_numpy(), 0
    for number, (_, steps) in enumerate(blocks):
        leaves = np.vstack(pdf[f"l{number}"].to_numpy()).astype(int)
        for tree, values in enumerate(steps):
            margin = margin + step * np.asarray(values)[leaves[:, tree]]
            bad, good = y.sum(), len(y) - y.sum()
            auc = (pd.Series(margin).rank()[y == 1].sum() - bad * (bad + 1) / 2) / (bad * good)
            assert found[at] == pytest.approx(auc, abs=1e-12)
            at += 1
    assert at == len(found)


def test_leaves_are_newton_steps_under_both_penalties(planted):
    """Two blocks of trees; every leaf value and staged margin once more with plain numbers."""
    settings = {"maxIter": 4, "maxDepth": 2, "stepSize": 0.3, "block": 2, "alpha": 3.0, "lambda": 2.0}
    fitted = challenger.fit_boosted_trees(planted, FEATURES, {**settings, "patience": 50})
    model = fitted.stages[-1].setLeafCol("leaves")
    rows = fitted.transform(planted).withColumn("apart", challenger.hash_cell("SK_ID_CURR", challenger.SEED + 2))
    pdf = rows.select("TARGET", "apart", vector_to_array("leaves").alias("leaves"), vector_to_array("rawPrediction")[1].alias("raw")).toPandas()
    weight = challenger.positive_weight(planted)
    y = pdf["TARGET"].to_numpy(float)
    w = np.where(y == 1, weight, 1.0)
    learned = (pdf["apart"] >= int(challenger.VALIDATION_SHARE * challenger.CELLS)).to_numpy()
    leaves = np.vstack(pdf["leaves"].to_numpy()).astype(int)
    margin, zeroed = np.zeros(len(y)), 0
    for first in range(0, model.getNumTrees, 2):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (y - p), w * p * (1 - p)
        for tree in range(first, min(first + 2, model.getNumTrees)):
            values = np.zeros(leaves[:, tree].max() + 1)
            for leaf in range(len(values)):
                own = learned & (leaves[:, tree] == leaf)
                size = abs(g[own].sum())
                zeroed += size <= 3
                values[leaf] = np.sign(g[own].sum()) * max(size - 3, 0) / (h[own].sum() + 2)
            margin = margin + 0.3 * values[leaves[:, tree]]
    assert np.allclose(2 * pdf["raw"], margin, atol=1e-9) and np.ptp(margin) > 0.1


def test_staged_margins_change_nothing(planted, monkeypatch):
    settings = {"maxIter": 6, "maxDepth": 2, "stepSize": 0.3, "block": 2, "patience": 50}
    settings |= {"subsamplingRate": 1.0, "featureSubsetStrategy": "all"}  # samples follow the order of rows
    once = challenger.fit_boosted_trees(planted, FEATURES, settings)
    monkeypatch.setattr(challenger, "STAGE_EVERY", 2)  # also measures after every block
    often = challenger.fit_boosted_trees(planted, FEATURES, settings)
    pd_of = lambda m: scorecard.probability_of_default(m.transform(planted)).orderBy("SK_ID_CURR").toPandas()["PD"]
    assert np.allclose(pd_of(once), pd_of(often), atol=1e-9)


def test_one_class_only_still_fits(spark):
    rows = [(i, 0, float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "SK_ID_CURR bigint, TARGET int, f0 double")
    model = challenger.fit_boosted_trees(df, ["f0"], {"maxIter": 40, "maxDepth": 2, "stepSize": 0.1, "patience": 2})
    assert model.stages[-1].getNumTrees == 4
    scored = scorecard.probability_of_default(model.transform(df))
    assert scored.where("PD > 0.5").count() == 0


def test_path_contributions_sum_to_the_margin(spark, fitted, planted):
    scored = fitted.transform(planted)
    nodes = attribution.tree_nodes(spark, fitted)
    parts = attribution.path_contributions(scored, nodes, FEATURES)
    margin = scored.select("SK_ID_CURR", vector_to_array("rawPrediction")[1].alias("margin"))
    joined = parts.join(margin, "SK_ID_CURR").toPandas()
    assert len(joined) == 6000
    assert np.allclose(joined["base"] + joined[FEATURES].sum(axis=1), joined["margin"], atol=1e-9)
    assert attribution.global_importance(parts, FEATURES).first().feature == "f0"


def test_riskiest_customer_is_from_the_whole_set(spark, fitted, planted):
    scored = scorecard.probability_of_default(fitted.transform(planted))
    parts = attribution.path_contributions(scored, attribution.tree_nodes(spark, fitted), FEATURES)
    explained = attribution.explain_riskiest(parts, scored.select("SK_ID_CURR", "PD"), FEATURES).collect()
    top = scored.orderBy(F.desc("PD"), "SK_ID_CURR").first()
    assert len(explained) == 5
    assert {r.SK_ID_CURR for r in explained} == {top.SK_ID_CURR}


def test_linear_contributions_sum(spark):
    woe = spark.createDataFrame([(1, 0.5, -1.0), (2, 0.1, 3.0)], "SK_ID_CURR bigint, a double, b double")
    rows = attribution.linear_contributions(woe, {"a": 2.0, "b": -1.0}).collect()
    assert sum(r.a for r in rows) == pytest.approx(0)
    assert {r.SK_ID_CURR: r.b for r in rows} == pytest.approx({1: 2.0, 2: -2.0})


def test_saved_model_scores_the_same(spark, fitted, planted, folder):
    sizes = planted.agg(F.count(F.lit(1)).alias("n"))
    sinks.save_model(fitted, sizes, folder, "trees")
    loaded, table = sinks.load_model(spark, folder, "trees")
    assert table.first().n == 6000
    before = scorecard.probability_of_default(fitted.transform(planted)).select("SK_ID_CURR", "PD")
    after = scorecard.probability_of_default(loaded.transform(planted)).select("SK_ID_CURR", "PD")
    assert before.exceptAll(after).count() == 0


def test_positive_weight_is_floored(spark):
    df = spark.createDataFrame([(0,)] * 11 + [(1,)] * 3, "TARGET int")
    assert challenger.positive_weight(df) == 3


def test_tier_edges(spark):
    scores = [0.0, 0.0001, 0.2, 0.2001, 0.4, 0.6, 0.8, 1.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = [r[0] for r in df.select(early_warning.risk_tier(F.col("s"))).collect()]
    assert got == [None, "Very Low", "Very Low", "Low", "Low", "Medium", "High", "Critical"]


def test_flag_uses_the_unrounded_score(spark):
    df = spark.createDataFrame([(1, 0, 0.49999), (2, 1, 0.5)], "SK_ID_CURR bigint, TARGET int, score double")
    rows = {r.SK_ID_CURR: r for r in early_warning.warning_flags(df).collect()}
    assert (rows[1].ew_score, rows[1].ew_flag) == (0.5, 0)
    assert rows[2].ew_flag == 1


def test_alignment_fills_absent_columns(spark):
    df = spark.createDataFrame([(1, None)], "SK_ID_CURR bigint, a double")
    assert early_warning.align_features(df, ["a", "b"]).first().asDict() == {"SK_ID_CURR": 1, "a": 0.0, "b": 0.0}


def test_masking_by_month(spark, small_store):
    masked = early_warning.masked_features(small_store.where("cc_util_l3m > 0"))
    sums = {
        r.months_before_default: (r.recent, r.trend)
        for r in masked.groupBy("months_before_default")
        .agg(F.sum("cc_util_l3m").alias("recent"), F.sum(F.abs("cc_util_trend")).alias("trend"))
        .collect()
    }
    assert sums[12] == (0.0, 0.0) and sums[6][0] == 0.0
    assert sums[6][1] > 0 and sums[1][0] > 0
