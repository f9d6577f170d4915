"""Stratified split and folds that give the same rows in every step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.functions.columns import hash_order
from arrears.functions.ordering import number_in_order

SEED = 42
CELLS = 16**4


def hash_cell(key: str, seed: int) -> Column:
    """One of ``CELLS`` equally likely cells per key."""
    return F.conv(F.substring(hash_order(key, seed), 1, 4), 16, 10).cast("int")


def stratified_split(
    df: DataFrame,
    train_share: float = 0.7,
    seed: int = SEED,
    key: str = "SK_ID_CURR",
    label: str = "TARGET",
) -> DataFrame:
    """Append ``is_train``: the given share of every class, chosen by hashed key."""
    celled = df.select(label, hash_cell(key, seed).alias("cell"))
    counted = celled.groupBy(label, "cell").agg(F.count(F.lit(1)).alias("n"))
    of_class = Window.partitionBy(label)  # at most CELLS rows, however many customers
    bounds = (
        counted.withColumns(
            {"upto": F.sum("n").over(of_class.orderBy("cell")), "total": F.sum("n").over(of_class)}
        )
        .where(F.col("upto") >= F.col("total") * train_share)
        .groupBy(label)
        .agg(F.min("cell").alias("_last_train_cell"))
    )
    # One row per class.
    return (
        df.join(F.broadcast(bounds), label)
        .withColumn("is_train", hash_cell(key, seed) <= F.col("_last_train_cell"))
        .select(*df.columns, "is_train")
    )


def folds(
    df: DataFrame, k: int = 5, seed: int = SEED, key: str = "SK_ID_CURR", label: str = "TARGET"
) -> DataFrame:
    """Append ``fold`` 0..k-1, dealt in hashed order within each class.

    The folds of a class differ by one row at most. They do not depend on the split.
    """
    placed = number_in_order(df, [hash_order(key, seed + 1), F.col(key)], by=[label])
    return placed.select(*df.columns, F.pmod(F.col("position") - 1, F.lit(k)).cast("int").alias("fold"))
