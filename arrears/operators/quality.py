"""Checks and profiles of the feature store."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.functions.columns import clip, share, stack_columns
from arrears.functions.counting import counted_quantiles
from arrears.operators.store import available
from arrears.sources.staging import stage

# The features of the correlation matrix.
KEY_FEATURES = [
    "ins_days_late_mean",
    "ins_underpay_ratio_mean",
    "ins_pct_late",
    "ins_late_momentum",
    "ins_days_late_l3m",
    "cc_util_mean",
    "cc_util_l3m",
    "cc_util_trend",
    "cc_dpd_max",
    "cc_min_pay_ratio_mean",
    "bur_delinq_rate",
    "bur_delinq_rate_12m",
    "bur_debt_credit_ratio",
    "bur_worst_status_ever",
    "stress_composite",
    "n_products_delinquent",
]


def _percent(part: F.Column, digits: int) -> F.Column:
    return F.round(F.lit(100.0) * part, digits)


def summary(store: DataFrame) -> DataFrame:
    return store.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("TARGET").alias("total_defaults"),
        _percent(F.avg("TARGET"), 2).alias("default_rate_pct"),
    )


def completeness(store: DataFrame) -> DataFrame:
    """Share of customers that have each product family."""

    def filled(column: str) -> F.Column:
        return _percent(share(F.count(column), F.count(F.lit(1))), 1)

    return store.agg(
        F.count(F.lit(1)).alias("n"),
        filled("ins_days_late_mean").alias("pct_has_installments"),
        filled("cc_util_mean").alias("pct_has_credit_card"),
        filled("bur_total_accounts").alias("pct_has_bureau"),
    )


def default_by_products(store: DataFrame) -> DataFrame:
    return (
        store.groupBy("n_products_delinquent")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            _percent(F.avg("TARGET"), 2).alias("default_rate_pct"),
        )
        .orderBy("n_products_delinquent")
    )


def means_by_target(store: DataFrame) -> DataFrame:
    return (
        store.groupBy("TARGET")
        .agg(
            F.round(F.avg("ins_days_late_mean"), 2).alias("avg_days_late"),
            F.round(F.avg("ins_underpay_ratio_mean"), 3).alias("avg_underpay"),
            F.round(F.avg("cc_util_mean"), 3).alias("avg_cc_util"),
            F.round(F.avg("bur_delinq_rate_12m"), 3).alias("avg_bur_delinq"),
            F.round(F.avg("stress_composite"), 4).alias("avg_stress"),
        )
        .orderBy("TARGET")
    )


def numeric_features(store: DataFrame) -> list[str]:
    return [
        f.name
        for f in store.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in ("SK_ID_CURR", "TARGET")
    ]


def missing_profile(store: DataFrame, top: int | None = None) -> DataFrame:
    """Share of missing values of every numeric column, largest first."""
    columns = numeric_features(store)
    shares = store.agg(
        *[F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(c) for c in columns]
    )
    ranked = shares.select(stack_columns(columns, "feature", "missing_share")).orderBy(
        F.desc("missing_share"), "feature"
    )
    return ranked if top is None else ranked.limit(top)


NEARLY_NOTHING = 1e-6  # of a sum of squares


def _moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows, means, centred squares and product of two columns where both have values.

    Values are taken relative to the first one, so a constant column has squares of
    exactly zero, whatever its size.
    """
    both = ~(np.isnan(x) | np.isnan(y))
    if not both.any():
        return np.zeros(6)
    x, y = x[both], y[both]
    dx, dy = x - x[0], y - y[0]
    mx, my = dx.mean(), dy.mean()
    ex, ey = dx - mx, dy - my
    return np.array([len(x), x[0] + mx, y[0] + my, ex @ ex, ey @ ey, ex @ ey])


def _all_moments(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``_moments`` of many pairs of columns at once, by four matrix products.

    ``left`` and ``right`` number the columns of the pairs. Values are taken relative to the
    first one of their column. Where sums of squares nearly cancel, as for a column that is
    constant beside the other one only, the pair is worked out on its own.
    """
    known = ~np.isnan(values)
    first = values[known.argmax(axis=0), np.arange(values.shape[1])]
    first = np.where(known.any(axis=0), first, 0.0)
    x, held = np.where(known, values - first, 0.0), known.astype(float)
    sums, squares = x.T @ held, (x * x).T @ held  # of the first column, over rows that have both
    n = (held.T @ held)[left, right]
    some = np.maximum(n, 1)
    sum_a, sum_b = sums[left, right], sums[right, left]
    square_a, square_b = squares[left, right], squares[right, left]
    spread_a, spread_b = square_a - sum_a**2 / some, square_b - sum_b**2 / some
    product = (x.T @ x)[left, right] - sum_a * sum_b / some
    out = np.stack(
        [n, first[left] + sum_a / some, first[right] + sum_b / some, spread_a, spread_b, product], axis=1
    )
    out[n == 0] = 0.0
    unsure = (spread_a < NEARLY_NOTHING * square_a) | (spread_b < NEARLY_NOTHING * square_b)
    for i in np.flatnonzero(unsure):
        out[i] = _moments(values[:, left[i]], values[:, right[i]])
    return out


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two disjoint sets of rows; one row per pair of columns."""
    n = a[:, 0] + b[:, 0]
    part = b[:, 0] / np.where(n > 0, n, 1)
    shift = np.where(a[:, 0:1] > 0, b[:, 1:3] - a[:, 1:3], 0.0)
    mean = np.where(a[:, 0:1] > 0, a[:, 1:3] + shift * part[:, None], b[:, 1:3])
    mean = np.where(b[:, 0:1] > 0, mean, a[:, 1:3])
    shift = np.where(b[:, 0:1] > 0, shift, 0.0)
    apart = np.stack([shift[:, 0] ** 2, shift[:, 1] ** 2, shift[:, 0] * shift[:, 1]], axis=1)
    spread = a[:, 3:] + b[:, 3:] + apart * (a[:, 0] * part)[:, None]
    return np.concatenate([n[:, None], mean, spread], axis=1)


def _correlations(store: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation per pair of columns over the rows that have both.

    Each task centres and adds up the moments of all pairs and passes on one row per
    pair; these are merged pairwise. Built-in aggregates would need several hundred
    buffers, and their generated code is too large to be compiled. A constant column has
    no correlation.
    """
    columns = sorted({c for pair in pairs for c in pair})
    left, right = (np.array([columns.index(pair[side]) for pair in pairs]) for side in (0, 1))
    sums = ["n", "mx", "my", "sxx", "syy", "sxy"]

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(pairs), 6))
        for batch in batches:
            if len(batch):
                total = _merged(total, _all_moments(batch.to_numpy(dtype=float), left, right))
        out = pd.DataFrame(total, columns=sums)
        out.insert(0, "pair", np.arange(len(pairs)))
        yield out[out["n"] > 0]

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        rows = parts.sort_values(sums)[sums].to_numpy(dtype=float)
        total = np.zeros((1, 6))
        for row in rows:  # one per task
            total = _merged(total, row[None, :])
        out = pd.DataFrame(total, columns=sums)
        out.insert(0, "pair", parts["pair"].iloc[0])
        return out

    kinds = "pair int, " + ", ".join(f"{c} double" for c in sums)
    moments = (
        store.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .mapInPandas(add_up, kinds)
        .groupBy("pair")
        .applyInPandas(merge, kinds)
    )
    named = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    listed = store.sparkSession.range(1).select(F.posexplode(named).alias("pair", "names"))
    spread = F.sqrt("sxx") * F.sqrt("syy")
    return listed.join(moments, "pair", "left").select(
        F.col("names.a").alias("feature_1"),
        F.col("names.b").alias("feature_2"),
        F.try_divide("sxy", spread).alias("corr"),
    )


def correlation_matrix(store: DataFrame, features: Sequence[str] = tuple(KEY_FEATURES)) -> DataFrame:
    """The lower triangle of the correlation matrix of the features and TARGET."""
    columns = available([*features, "TARGET"], store)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return _correlations(store, pairs)


def target_correlation(
    store: DataFrame, features: Sequence[str] = tuple(KEY_FEATURES), top: int | None = 10
) -> DataFrame:
    """Features by absolute correlation with TARGET, strongest first."""
    found = _correlations(store, [(c, "TARGET") for c in available(list(features), store)])
    ranked = found.select(
        F.col("feature_1").alias("feature"), F.abs("corr").alias("abs_corr")
    ).orderBy(F.desc_nulls_last("abs_corr"), "feature")
    return ranked if top is None else ranked.limit(top)


def density(long: DataFrame, value: str, by: Sequence[str], bins: int) -> DataFrame:
    """Density histogram of ``value`` per group over the group's own range.

    Every bin is listed, also the empty ones.
    """
    by = list(by)
    bounds = long.groupBy(*by).agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("total")
    )
    flat = F.col("low") == F.col("high")
    ranges = stage(
        bounds.select(
            *by,
            "total",
            F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        )
    )
    index = F.floor((F.col(value) - F.col("low")) * bins / (F.col("high") - F.col("low")))
    counted = (
        long.join(ranges, by)
        .groupBy(*by, F.least(index, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(value).alias("n"))
    )
    width = (F.col("high") - F.col("low")) / bins
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counted, [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)) / (F.col("total") * width)).alias("density"),
    )


def class_histogram(
    store: DataFrame, features: Sequence[str], bins: int = 50, tails: tuple[float, float] = (0.01, 0.99)
) -> DataFrame:
    """Density of each feature per class after clipping both classes to common tails."""
    wide = stage(store.select("TARGET", *features))
    long = wide.select("TARGET", stack_columns(list(features), "feature", "value")).where(
        F.col("value").isNotNull()
    )
    edges = counted_quantiles(wide, list(features), tails).withColumnRenamed("column", "feature")
    clipped = long.join(edges, "feature").select(
        "feature", "TARGET", clip(F.col("value"), F.col("q0"), F.col("q1")).alias("value")
    )
    return density(clipped, "value", ["feature", "TARGET"], bins)
