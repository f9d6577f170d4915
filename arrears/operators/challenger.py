"""The challenger: gradient-boosted trees on the raw features.

Boosting goes on from the margin that the trees so far give. A block of trees is fitted at
once on the Newton targets of that margin, (y - p) / (p (1 - p)) weighted by p (1 - p), so
that splits are chosen by second-order gain; the trees differ by their samples of rows and
features. One aggregate of gradients and Hessians by tree and leaf then sets every leaf to
its Newton step under L1 and L2 penalties. No tree is fitted twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.operators.split import CELLS, SEED, hash_cell
from arrears.sources.staging import stage

# Boosting settings of the challenger and of the early-warning model.
CHALLENGER = {"maxIter": 500, "maxDepth": 5, "stepSize": 0.05, "patience": 30}
EARLY_WARNING = {"maxIter": 300, "maxDepth": 4, "stepSize": 0.05, "patience": 20}
COMMON = {"subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "minInstancesPerNode": 10}
PENALTIES = {"alpha": 0.1, "lambda": 1.0}  # L1 and L2 at the leaves

VALIDATION_SHARE = 0.2
BLOCK = 10  # trees fitted at once on one margin
STAGE_EVERY = 20  # trees after which the AUC is measured and the margins are written
LEAST_HESSIAN = 1e-6
PART = pa.schema(
    [("round", pa.int32()), ("low", pa.float64()), ("bad", pa.int64()), ("good", pa.int64()), ("twice", pa.int64())]
)


def class_weights(train: DataFrame, label: str = "TARGET") -> DataFrame:
    """One row: whole number of good rows per bad row, and the balanced class weights."""
    n, bad = F.count(F.lit(1)), F.sum(F.col(label))
    return train.agg(
        F.floor(F.try_divide(n - bad, bad)).alias("positive_weight"),
        F.try_divide(n, 2 * (n - bad)).alias("balanced_good"),
        F.try_divide(n, 2 * bad).alias("balanced_bad"),
    )


def positive_weight(train: DataFrame, label: str = "TARGET") -> int:
    """Weight of a bad row in boosting; at least one."""
    return max(int(class_weights(train, label).first().positive_weight or 1), 1)


def input_names(features: Sequence[str], flag_missing: bool) -> list[str]:
    """The model inputs in vector order: values, then missing flags."""
    return [f"x_{f}" for f in features] + ([f"{f}_missing" for f in features] if flag_missing else [])


def input_stages(features: Sequence[str], flag_missing: bool) -> list:
    """Zero for missing values, flagged if wanted; the same at fitting and at scoring."""
    columns = [f"coalesce(CAST(`{f}` AS DOUBLE), 0e0) AS `x_{f}`" for f in features]
    if flag_missing:
        columns += [f"CAST(`{f}` IS NULL AS DOUBLE) AS `{f}_missing`" for f in features]
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__"),
        VectorAssembler(inputCols=input_names(features, flag_missing), outputCol="features"),
    ]


def leaf_value(gradient: float, hessian: float, penalties: dict[str, float]) -> float:
    """The Newton step of a leaf in log-odds: soft-thresholded gradient over damped Hessian."""
    size = max(abs(gradient) - penalties["alpha"], 0.0)
    damped = hessian + penalties["lambda"]
    return (size if gradient > 0 else -size) / damped if damped > 0 else 0.0


def _java_trees(trees: Sequence) -> tuple:
    """An array of tree models for the JVM, and the gateway."""
    gateway = SparkSession.active().sparkContext._gateway
    kind = gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    array = gateway.new_array(kind, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree
    return array, gateway


def _java_weights(gateway, step: float, count: int):
    weights = gateway.new_array(gateway.jvm.double, count)
    for i in range(count):
        weights[i] = step
    return weights


def _with_leaves(tree, sums: dict[int, tuple[float, float]], penalties: dict[str, float]) -> tuple:
    """The tree with Newton steps at its leaves, and the steps by number of the leaf.

    Inner nodes predict the mean of their leaves, weighted by Hessian. The model's margins
    are half the log-odds, so are the predictions.
    """
    nodes = SparkSession.active().sparkContext._gateway.jvm.org.apache.spark.ml.tree
    steps: list[float] = []

    def rebuilt(node) -> tuple:
        if node.subtreeDepth() == 0:
            gradient, hessian = sums.get(len(steps), (0.0, 0.0))
            value = leaf_value(gradient, hessian, penalties)
            steps.append(value)
            return nodes.LeafNode(value / 2, node.impurity(), node.impurityStats()), value, hessian
        left, left_value, left_weight = rebuilt(node.leftChild())
        right, right_value, right_weight = rebuilt(node.rightChild())
        weight = left_weight + right_weight
        value = (left_value * left_weight + right_value * right_weight) / weight if weight else 0.0
        inner = nodes.InternalNode(
            value / 2, node.impurity(), node.gain(), left, right, node.split(), node.impurityStats()
        )
        return inner, value, weight

    root, _, _ = rebuilt(tree.rootNode())
    kind = SparkSession.active().sparkContext._gateway.jvm.org.apache.spark.ml.regression
    return kind.DecisionTreeRegressionModel(tree.uid(), root, tree.numFeatures()), steps


def _ensemble(trees: Sequence, step: float) -> GBTRegressionModel:
    """Half the log-odds that the trees add, as ``_half``."""
    array, gateway = _java_trees(trees)
    made = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(
        "gbtr_margin", array, _java_weights(gateway, step, len(trees)), trees[0].numFeatures()
    )
    return GBTRegressionModel(made).setFeaturesCol("features").setPredictionCol("_half")


def _with_margin(vectors: DataFrame, trees: Sequence, step: float) -> DataFrame:
    """``margin`` after more trees, in log-odds."""
    if not trees:
        return vectors
    added = _ensemble(trees, step).transform(vectors)
    return added.withColumn("margin", F.col("margin") + 2 * F.col("_half")).drop("_half")


def _gradients(rows: DataFrame, label: str) -> DataFrame:
    """Gradient and Hessian of the weighted log-likelihood, and the Newton target."""
    p = 1 / (1 + F.exp(-F.col("margin")))
    hessian = F.greatest(p * (1 - p), F.lit(LEAST_HESSIAN))
    return rows.withColumns(
        {
            "_gradient": F.col("weight") * (F.col(label) - p),
            "_hessian": F.col("weight") * hessian,
            "_newton": (F.col(label) - p) / hessian,
        }
    )


def leaf_sums(rows: DataFrame, forest: RandomForestRegressionModel) -> list[dict[int, tuple[float, float]]]:
    """Per tree, the sums of gradient and Hessian in every leaf: one row per leaf arrives."""
    leaves = forest.setLeafCol("leaves").transform(rows)
    found = (
        leaves.select(F.posexplode(vector_to_array("leaves")).alias("tree", "leaf"), "_gradient", "_hessian")
        .groupBy("tree", "leaf")
        .agg(F.sum("_gradient").alias("gradient"), F.sum("_hessian").alias("hessian"))
    )
    sums: list[dict[int, tuple[float, float]]] = [{} for _ in range(forest.getNumTrees)]
    for r in found.collect():
        sums[r.tree][int(r.leaf)] = (r.gradient, r.hessian)
    return sums


def staged_auc(
    validation: DataFrame, blocks: Sequence[tuple[RandomForestRegressionModel, list[list[float]]]], step: float, label: str
) -> list[float | None]:
    """The exact AUC after each further tree of the blocks, from counts of equal margins.

    The leaves are written once. Tasks add up the margins of all rounds and count equal ones;
    one shuffle brings the counts into order by round and margin, and each slice passes on its
    rows of both classes and its pairs in order, a row per round.
    """
    rows, named = validation.where(F.col(label).isNotNull()), []
    for number, (forest, _) in enumerate(blocks):
        own = f"_leaves_{number}"
        rows = forest.setLeafCol(own).transform(rows).drop("_forest")
        named.append(vector_to_array(own))
    tables = [np.array([step * v for v in values]) for _, steps in blocks for values in steps]
    count = len(tables)

    def margins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            y = batch.column("label").to_numpy().astype(np.int64)
            score = batch.column("margin").to_numpy()
            leaves = batch.column("leaves").flatten().to_numpy().reshape(len(y), count)
            for number, table in enumerate(tables):
                score = score + table[leaves[:, number]]
                distinct, at = np.unique(score + 0.0, return_inverse=True)  # -0.0 is 0.0
                held, bad = np.bincount(at), np.bincount(at, weights=y).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "round": pa.array(np.full(len(distinct), number, np.int32)),
                        "score": pa.array(distinct),
                        "bad": pa.array(bad),
                        "good": pa.array(held - bad),
                    }
                )

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}  # round -> lowest margin, bad, good, twice the pairs in order
        for batch in batches:
            rounds, score, bad, good = (batch.column(c).to_numpy() for c in ("round", "score", "bad", "good"))
            for number in np.unique(rounds):
                own = slice(*np.searchsorted(rounds, [number, number + 1]))
                held = found.setdefault(int(number), [float(score[own][0]), 0, 0, 0])
                below = held[2] + np.cumsum(good[own]) - good[own]
                held[3] += int((bad[own] * (2 * below + good[own])).sum())
                held[1] += int(bad[own].sum())
                held[2] += int(good[own].sum())
        yield pa.RecordBatch.from_pylist(
            [dict(zip(PART.names, (n, *held), strict=True)) for n, held in found.items()], schema=PART
        )

    leaves = F.concat(*named).cast("array<int>").alias("leaves")
    narrow = stage(rows.select(F.col(label).cast("bigint").alias("label"), "margin", leaves))
    counted = narrow.mapInArrow(margins, "round int, score double, bad bigint, good bigint")
    distinct = (
        counted.repartitionByRange("round", "score")
        .groupBy("round", "score")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .sortWithinPartitions("round", "score")
    )
    parts = distinct.mapInArrow(pairs, "round int, low double, bad bigint, good bigint, twice bigint").collect()
    aucs: list[float | None] = []
    for number in range(count):
        bad = good = twice = 0
        for r in sorted((r for r in parts if r["round"] == number), key=lambda r: r.low):
            twice += r.twice + 2 * r.bad * good
            bad, good = bad + r.bad, good + r.good
        aucs.append(twice / 2 / (bad * good) if bad and good else None)
    return aucs


def best_round(measured: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round with the highest value so far, and whether ``patience`` others brought no more.

    Rounds are looked at one after the other: what comes after the stop never counts.
    """
    best = 0
    for i, value in enumerate(measured):
        if value > measured[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    settings: dict | None = None,
    flag_missing: bool = True,
    label: str = "TARGET",
    key: str = "SK_ID_CURR",
) -> PipelineModel:
    """Fit on the training rows and keep the rounds up to the highest validation AUC.

    A hashed slice of the training rows, never of the test rows, measures the AUC after
    every round; boosting ends when ``patience`` rounds have not raised it. Where it cannot
    be measured (a class is missing there), twice ``patience`` rounds are kept. Margins
    start at zero, every tree counts ``stepSize`` times its leaf values.
    """
    chosen = {**CHALLENGER, **COMMON, "block": BLOCK, **PENALTIES, **(settings or {})}
    most, patience, block = chosen.pop("maxIter"), chosen.pop("patience"), chosen.pop("block")
    penalties = {name: chosen.pop(name) for name in PENALTIES}
    step = chosen.pop("stepSize")
    weight = positive_weight(train, label)
    stages = input_stages(features, flag_missing)
    rows = train.select(key, label, *features)
    for transformer in stages:
        rows = transformer.transform(rows)
    vectors = stage(
        rows.select(
            F.col(label).cast("double").alias(label),
            F.when(F.col(label) == 1, float(weight)).otherwise(1.0).alias("weight"),
            (hash_cell(key, SEED + 2) < int(VALIDATION_SHARE * CELLS)).alias("is_validation"),
            "features",
            F.lit(0.0).alias("margin"),
        )
    )
    trees: list = []
    blocks: list = []  # those whose rounds have not been measured yet
    measured: list[float] = []
    staged, stopped, best = 0, False, 0
    while not stopped and len(trees) < most:
        current = _gradients(_with_margin(vectors, trees[staged:], step), label)
        learning = current.where("NOT is_validation")
        forest = RandomForestRegressor(
            labelCol="_newton", featuresCol="features", weightCol="_hessian", predictionCol="_forest",
            numTrees=block, bootstrap=False, seed=SEED + len(trees), **chosen,
        ).fit(learning)
        sums = leaf_sums(learning, forest)
        made = [_with_leaves(t, s, penalties) for t, s in zip(forest._java_obj.trees(), sums, strict=True)]
        trees += [tree for tree, _ in made]
        blocks.append((forest, [steps for _, steps in made]))
        if len(trees) - staged < STAGE_EVERY and len(trees) < most:
            continue
        found = staged_auc(vectors.where("is_validation"), blocks, step, label)
        if found[0] is None:
            best, most = len(trees), min(most, 2 * patience)
        else:
            measured += found
            best, stopped = best_round(measured[:most], patience)
        if not stopped and len(trees) < most:
            vectors, staged, blocks = stage(_with_margin(vectors, trees[staged:], step)), len(trees), []
    kept = trees[: min(best, most)]
    array, gateway = _java_trees(kept)
    model = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        "gbtc_challenger", array, _java_weights(gateway, step, len(kept)), kept[0].numFeatures(), 2
    )
    settled = GBTClassifier(
        labelCol=label, featuresCol="features", weightCol="weight", seed=SEED, maxIter=most, stepSize=step,
        **chosen,
    )
    return PipelineModel([*stages, settled._copyValues(GBTClassificationModel(model))])


def first_trees(model: GBTClassificationModel, count: int) -> GBTClassificationModel:
    """The model after its first ``count`` rounds."""
    if count >= model.getNumTrees:
        return model
    whole = model._java_obj
    array, gateway = _java_trees([whole.trees()[i] for i in range(count)])
    weights = gateway.new_array(gateway.jvm.double, count)
    for i in range(count):
        weights[i] = whole.treeWeights()[i]
    shorter = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        whole.uid(), array, weights, whole.numFeatures(), whole.numClasses()
    )
    return model._copyValues(GBTClassificationModel(shorter))
