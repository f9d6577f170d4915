"""Discrimination and stability of scores.

Frames hold one row per scored customer: the optional group columns ``by`` (model, sample,
month), a ``score`` and a 0/1 ``label``. Equal scores collapse to one row
before any ordering, so ties are exact and cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.functions.columns import share
from arrears.functions.counting import counted_quantiles
from arrears.functions.ordering import (
    exact_quantiles,
    number_in_order,
    with_group_totals,
    with_group_values,
)
from arrears.operators.quality import density
from arrears.sources.staging import stage

PSI_BINS = 10
EMPTY_SHARE = 1e-6  # stands in for an empty bin's share
GAIN_BINS = 20


def ranked_scores(
    df: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label"
) -> DataFrame:
    """Distinct scores, highest first, with cumulative bad and good counts."""
    usable = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    distinct = usable.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("bad"),
        F.sum(1 - F.col(label).cast("bigint")).alias("good"),
    )
    placed = number_in_order(
        distinct, [F.desc("score")], totals={"cum_bad": "bad", "cum_good": "good"}, by=by
    )
    # The rows are staged by now, and the last running total is that of the group.
    return with_group_totals(
        placed, by, [F.max("cum_bad").alias("all_bad"), F.max("cum_good").alias("all_good")]
    )


def ks_curve(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cumulative bad and good shares and their distance at each score."""
    bad = share(F.col("cum_bad"), F.col("all_bad"))
    good = share(F.col("cum_good"), F.col("all_good"))
    return ranked.select(
        *by, "score", bad.alias("cum_bad"), good.alias("cum_good"), F.abs(bad - good).alias("ks")
    )


def roc_points(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return ranked.select(
        *by,
        "score",
        share(F.col("cum_good"), F.col("all_good")).alias("fpr"),
        share(F.col("cum_bad"), F.col("all_bad")).alias("tpr"),
    )


def rank_metrics(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUC (ties count half), Gini and KS per group."""
    good_below = F.col("all_good") - F.col("cum_good") + F.col("good") / 2
    bad, good = F.col("all_bad").cast("double"), F.col("all_good").cast("double")
    distance = F.abs(share(F.col("cum_bad"), bad) - share(F.col("cum_good"), good))
    pairs = F.max(bad * good)
    return (
        ranked.groupBy(*by)
        .agg(
            F.try_divide(F.sum(F.col("bad") * good_below), pairs).alias("auc"),
            F.max(distance).alias("ks"),
        )
        .select(*by, "auc", (2 * F.col("auc") - 1).alias("gini"), "ks")
    )


def ks_position(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The score at which the cumulative shares are farthest apart (the highest such)."""
    curve = ks_curve(ranked, by)
    return curve.groupBy(*by).agg(
        F.max("ks").alias("ks"),
        F.max_by("score", F.struct("ks", "score")).alias("score"),
    )


def psi_bins(
    df: DataFrame,
    by: Sequence[str] = (),
    score: str = "score",
    expected: str = "is_train",
    bins: int = PSI_BINS,
) -> DataFrame:
    """Shares of the expected and the other rows in quantile bins of the expected ones.

    The outer bins are open; an empty bin gets a tiny share.
    """
    by = list(by)
    scored = stage(
        df.select(*by, F.col(score).alias("score"), F.col(expected).alias("expected")).where(
            F.col("score").isNotNull()
        )
    )
    shares = [i / bins for i in range(1, bins)]
    of_expected = scored.where("expected")
    # Groups may be many; without them the edges are counted.
    if by:
        edges = exact_quantiles(of_expected, "score", shares, by)
    else:
        edges = counted_quantiles(of_expected, ["score"], shares).drop("column")
    columns = [f"q{i}" for i in range(bins - 1)]
    edged = with_group_values(scored, by, edges)
    index = sum(((F.col("score") >= F.col(c)).cast("int") for c in columns), F.lit(0))
    counted = edged.groupBy(*by, index.alias("bin")).agg(
        F.count(F.when(F.col("expected"), 1)).alias("n_expected"),
        F.count(F.when(~F.col("expected"), 1)).alias("n_actual"),
    )
    listed = edges.select(
        *by,
        F.posexplode(
            F.array(
                *[
                    F.struct(
                        (F.col(columns[i - 1]) if i else F.lit(None).cast("double")).alias("low"),
                        (F.col(columns[i]) if i < bins - 1 else F.lit(None).cast("double")).alias("high"),
                    )
                    for i in range(bins)
                ]
            )
        ).alias("bin", "limits"),
    )
    full = listed.join(counted, [*by, "bin"], "left")
    sized = with_group_totals(
        full, by, [F.sum("n_expected").alias("all_expected"), F.sum("n_actual").alias("all_actual")]
    )

    def part(kind: str) -> Column:
        held = F.coalesce(share(F.col(f"n_{kind}"), F.col(f"all_{kind}")), F.lit(0.0))
        return F.when(held == 0, EMPTY_SHARE).otherwise(held)

    return sized.select(
        *by,
        "bin",
        "limits.low",
        "limits.high",
        part("expected").alias("expected_share"),
        part("actual").alias("actual_share"),
    )


def psi(bins: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Population stability index from the shares per bin."""
    a, e = F.col("actual_share"), F.col("expected_share")
    return bins.groupBy(*by).agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))


def psi_status(value: Column) -> Column:
    return F.when(value < 0.10, "stable").when(value < 0.25, "watch").otherwise("alert")


def fit_checks(metrics: DataFrame) -> DataFrame:
    """Train and test rows of (sample, auc) to one row of warnings."""
    by_sample = metrics.agg(
        F.max(F.when(F.col("sample") == "train", F.col("auc"))).alias("auc_train"),
        F.max(F.when(F.col("sample") == "test", F.col("auc"))).alias("auc_test"),
    )
    gap = F.col("auc_train") - F.col("auc_test")
    return by_sample.select(
        "auc_train",
        "auc_test",
        gap.alias("auc_gap"),
        (gap > 0.05).alias("overfit"),
        (F.col("auc_test") < 0.65).alias("weak_model"),
    )


def score_density(df: DataFrame, score: str = "score", label: str = "label", bins: int = 50) -> DataFrame:
    """Density of the score per sample and class."""
    scored = stage(
        df.where(F.col(score).isNotNull()).select(
            F.when(F.col("is_train"), "train").otherwise("test").alias("sample"),
            F.col(label).alias("label"),
            F.col(score).alias("value"),
        )
    )
    return density(scored, "value", ["sample", "label"], bins)


def gain_curve(
    df: DataFrame,
    by: Sequence[str] = (),
    key: str = "SK_ID_CURR",
    score: str = "score",
    label: str = "label",
    bins: int = GAIN_BINS,
) -> DataFrame:
    """Share of all bad customers among the highest scores, in equal rank bins."""
    by = list(by)
    rows = stage(
        df.select(*by, key, F.col(score).alias("score"), F.col(label).alias("label")).where(
            F.col("score").isNotNull()
        )
    )
    whole = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("size"), F.sum("label").alias("all_bad")
    )
    placed = number_in_order(rows, [F.desc("score"), F.col(key)], by=by)
    sized = with_group_values(placed, by, whole)
    reach = F.try_divide((F.col("position") - 1) * bins, F.col("size") - 1)
    index = F.greatest(F.ceil(F.coalesce(reach, F.lit(0.0))).cast("int") - 1, F.lit(0))
    held = sized.groupBy(*by, index.alias("bin")).agg(F.sum("label").alias("bad"))
    grid = whole.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    upto = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    # One row per bin and group.
    return grid.join(held, [*by, "bin"], "left").select(
        *by,
        ((F.col("bin") + 1) / bins).alias("pct_pop"),
        share(F.sum(F.coalesce("bad", F.lit(0))).over(upto), F.col("all_bad")).alias("cum_bad_rate"),
    )


def model_comparison(df: DataFrame, baseline: str) -> DataFrame:
    """Test AUC, Gini, KS and PSI per ``model`` and the AUC gained over the baseline."""
    scores = stage(df.select("model", "score", "label", "is_train"))
    ranked = ranked_scores(scores.where(~F.col("is_train")), ["model"])
    drift = psi(psi_bins(scores, ["model"]), ["model"])
    # One row per model; staged, as the baseline is looked up in it.
    joined = stage(rank_metrics(ranked, ["model"]).join(drift, "model", "left"))
    base = F.max(F.when(F.col("model") == baseline, F.col("auc"))).alias("base_auc")
    compared = with_group_totals(joined, (), [base])
    return compared.select(
        "model", "auc", "gini", "ks", "psi", (F.col("auc") - F.col("base_auc")).alias("auc_gain")
    )


def model_health(comparison: DataFrame) -> DataFrame:
    return comparison.select("model", "auc", "gini", "ks", "psi", psi_status(F.col("psi")).alias("psi_status"))
