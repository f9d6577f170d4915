"""How much each feature moves a customer's score."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.functions.columns import stack_columns
from arrears.sources.staging import new_folder


def linear_contributions(
    woe: DataFrame, coefs: Mapping[str, float], key: str = "SK_ID_CURR"
) -> DataFrame:
    """Exact additive contributions coef * (WOE - mean WOE), one column per feature."""
    means = woe.agg(*[F.avg(f).alias(f) for f in coefs])
    centred = woe.withColumn("_mean", means.select(F.struct(*coefs)).scalar())
    return centred.select(
        key, *[((F.col(f) - F.col("_mean")[f]) * F.lit(float(c))).alias(f) for f, c in coefs.items()]
    )


def global_importance(
    contributions: DataFrame, features: Sequence[str], top: int | None = 20
) -> DataFrame:
    """Mean absolute contribution per feature, largest first; None lists all features."""
    means = contributions.agg(*[F.avg(F.abs(f)).alias(f) for f in features])
    ranked = means.select(stack_columns(features, "feature", "importance")).orderBy(
        F.desc("importance"), "feature"
    )
    return ranked if top is None else ranked.limit(top)


def explain_riskiest(
    contributions: DataFrame,
    scores: DataFrame,
    features: Sequence[str],
    top: int | None = 15,
    key: str = "SK_ID_CURR",
) -> DataFrame:
    """The largest contributions (None: all) of the customer with the highest ``PD``."""
    riskiest = scores.orderBy(F.desc_nulls_last("PD"), key).limit(1).select(key, "PD")
    one = contributions.join(F.broadcast(riskiest), key)
    ranked = one.select(key, "PD", stack_columns(features, "feature", "contribution")).orderBy(
        F.desc(F.abs("contribution")), "feature"
    )
    return ranked if top is None else ranked.limit(top)


def tree_nodes(spark: SparkSession, model: PipelineModel) -> pd.DataFrame:
    """Nodes of a fitted boosted-tree pipeline, with each tree's weight.

    They come from the model's own saved node data. The table is bounded by the number
    of trees and their depth, whatever the number of customers.
    """
    trees = model.stages[-1]
    path = new_folder(spark)
    trees.save(path)
    node = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["prediction"].alias("prediction"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
    )
    table = nodes.toPandas().sort_values(["tree", "node"], ignore_index=True)
    table["weight"] = np.asarray(trees.treeWeights)[table["tree"]]
    return table


Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def tree_arrays(nodes: pd.DataFrame) -> list[Tree]:
    """Per tree: left and right child, feature, threshold and weighted prediction of each node."""
    return [
        (
            *[tree[c].to_numpy() for c in ("left", "right", "feature", "threshold")],
            tree["prediction"].to_numpy() * tree["weight"].to_numpy(),
        )
        for _, tree in nodes.groupby("tree")
    ]


def walk_trees(trees: Sequence[Tree], inputs: np.ndarray) -> tuple[float, np.ndarray]:
    """Expected margin, and per row and input what the splits on its paths add to it."""
    added = np.zeros_like(inputs)
    rows = np.arange(len(inputs))
    base = 0.0
    for left, right, feature, threshold, value in trees:
        base += value[0]
        at = np.zeros(len(inputs), dtype=int)
        inner = left[at] >= 0
        while inner.any():
            here, which = at[inner], rows[inner]
            split_on = feature[here]
            child = np.where(inputs[which, split_on] <= threshold[here], left[here], right[here])
            added[which, split_on] += value[child] - value[here]
            at[inner] = child
            inner = left[at] >= 0
    return base, added


def path_contributions(
    scored: DataFrame, nodes: pd.DataFrame, features: Sequence[str], key: str = "SK_ID_CURR"
) -> DataFrame:
    """What each feature adds to a customer's margin along the paths through the trees.

    ``base`` plus all contributions is the margin. The inputs are the features, followed
    by their missing flags if the model has any; a flag's part goes to its feature.
    """
    names = list(features)
    shared = scored.sparkSession.sparkContext.broadcast(tree_arrays(nodes))

    def contribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            base, added = walk_trees(shared.value, np.vstack(batch["inputs"].to_numpy()))
            parts = added.reshape(len(batch), -1, len(names)).sum(axis=1)
            out = pd.DataFrame(parts, columns=names)
            out.insert(0, "base", base)
            out.insert(0, key, batch[key].to_numpy())
            yield out

    inputs = scored.select(key, vector_to_array("features").alias("inputs"))
    columns = ", ".join(f"`{f}` double" for f in names)
    return inputs.mapInPandas(contribute, f"`{key}` bigint, base double, {columns}")
