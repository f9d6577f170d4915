"""The points scorecard: logistic regression on WOE values."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions.ordering import with_group_totals
from arrears.operators.binning import (
    MISSING,
    information_values,
    optimal_bins,
    select_by_iv,
    woe_expressions,
)
from arrears.operators.metrics import rank_metrics, ranked_scores
from arrears.operators.split import folds
from arrears.sources.staging import stage

# Scorecard scaling and regularisation.
PDO = 20
BASE_POINTS = 600
BASE_ODDS = 1
INVERSE_REGULARISATION = 0.1

NEWTON_PASSES = 50
NEWTON_TOLERANCE = 1e-12  # of the loss
STEP_TOLERANCE = 1e-9  # of a coefficient


def balanced_weights(df: DataFrame, label: str = "TARGET") -> DataFrame:
    """Append ``weight`` that gives both classes the same total."""
    sized = with_group_totals(
        df, (), [F.count(F.lit(1)).alias("_n"), F.sum(F.col(label)).alias("_bad")]
    )
    in_class = F.when(F.col(label) == 1, F.col("_bad")).otherwise(F.col("_n") - F.col("_bad"))
    return sized.withColumn("weight", F.col("_n") / (2 * in_class)).select(*df.columns, "weight")


def logistic_regression(rows: int, label: str = "TARGET") -> LogisticRegression:
    """L2 logistic regression with the penalty scaled to the number of rows."""
    return LogisticRegression(
        labelCol=label,
        featuresCol="features",
        weightCol="weight",
        regParam=1.0 / (INVERSE_REGULARISATION * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
    )


def woe_stages(expressions: Mapping[str, str]) -> list:
    """Pipeline stages from raw features to the vector of their WOE values."""
    added = ", ".join(f"{sql} AS `woe_{feature}`" for feature, sql in expressions.items())
    return [
        SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__"),
        VectorAssembler(inputCols=[f"woe_{f}" for f in expressions], outputCol="features"),
    ]


def informative_bins(
    train: DataFrame, features: Sequence[str], label: str = "TARGET"
) -> tuple[DataFrame, list[str]]:
    """Bin table of all features and the features with enough information, best first.

    The trend of a feature may turn once. Where no feature clears a bar, as on large tables
    whose features hardly tell the classes apart, all that carry any information are taken.
    """
    narrow = stage(train.select(label, *features))
    bins = stage(optimal_bins(narrow, features, label, turns=1))
    ranked = stage(information_values(bins))
    selected = [r.feature for r in select_by_iv(ranked).orderBy(F.desc("IV"), "feature").collect()]
    if not selected:
        informative = ranked.where(F.col("IV") > 0).orderBy(F.desc("IV"), "feature")
        selected = [r.feature for r in informative.collect()]
    if not selected:
        raise ValueError("no feature carries information about the label")
    return bins, selected


def fit_scorecard(
    train: DataFrame, features: Sequence[str], label: str = "TARGET"
) -> tuple[PipelineModel, DataFrame, list[str]]:
    """Bin, select by information value and fit; returns model, bin table and features."""
    bins, selected = informative_bins(train, features, label)
    weighted = stage(balanced_weights(train.select(label, *selected), label))
    stages = [*woe_stages(woe_expressions(bins, selected)), logistic_regression(weighted.count(), label)]
    return Pipeline(stages=stages).fit(weighted), bins, selected


def fold_models(data: DataFrame, k: int, label: str = "TARGET") -> list[np.ndarray]:
    """Coefficients, the intercept last, of ``k`` models that each leave one fold out.

    ``data`` has the label, ``fold`` and the inputs as an array ``x``. All models take one
    Newton step a pass: a task adds up the loss, gradient and Hessian of every model over
    the rows of the other folds and passes on one row per model. The loss is that of
    ``logistic_regression`` with classes balanced within the rows a model sees, so its own
    fold takes no part in its weights. A step that does not lower the loss is halved.
    """
    sizes = data.groupBy("fold", label).agg(F.count(F.lit(1)).alias("n")).collect()
    width = len(data.select("x").first().x) + 1
    held = {(r.fold, r[label]): r.n for r in sizes}
    class_sizes = [[sum(n for (f, y), n in held.items() if f != m and y == c) for c in (0, 1)] for m in range(k)]
    weights = [[sum(own) / (2 * max(n, 1)) for n in own] for own in class_sizes]
    penalty = np.append(np.ones(width - 1), 0.0)
    betas = [np.zeros(width) for _ in range(k)]
    steps, best = [np.zeros(width) for _ in range(k)], [math.inf] * k
    open_models = list(range(k))
    for _ in range(NEWTON_PASSES):
        tried = {m: betas[m] + steps[m] for m in open_models}
        for m, (loss, gradient, hessian) in _newton_sums(data, tried, weights, label).items():
            beta = tried[m]
            total = INVERSE_REGULARISATION * loss + penalty @ (beta * beta) / 2
            if total > best[m] + NEWTON_TOLERANCE * abs(total):
                steps[m] = steps[m] / 2
                continue
            betas[m], best[m] = beta, total
            slope = INVERSE_REGULARISATION * gradient + penalty * beta
            curve = INVERSE_REGULARISATION * hessian + np.diag(penalty)
            steps[m] = -np.linalg.lstsq(curve, slope, rcond=None)[0]
            if np.abs(steps[m]).max() < STEP_TOLERANCE:
                open_models.remove(m)
        if not open_models:
            return betas
    raise RuntimeError("the folds' models did not converge")


def _newton_sums(
    data: DataFrame, betas: Mapping[int, np.ndarray], weights: Sequence[Sequence[float]], label: str
) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Loss, gradient and Hessian of each model over the rows of the other folds."""
    width = len(next(iter(betas.values())))

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {m: np.zeros(1 + width + width * width) for m in betas}
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy().reshape(len(y), width - 1)
            x = np.hstack([x, np.ones((len(y), 1))])
            for m, beta in betas.items():
                used = fold != m
                rows, bad = x[used], y[used]
                weight = np.where(bad == 1, weights[m][1], weights[m][0])
                margin = rows @ beta
                p = 1 / (1 + np.exp(-margin))
                sums[m][0] += weight @ (np.logaddexp(0, margin) - bad * margin)
                sums[m][1 : width + 1] += rows.T @ (weight * (p - bad))
                sums[m][width + 1 :] += ((rows * (weight * p * (1 - p))[:, None]).T @ rows).ravel()
        yield pa.RecordBatch.from_pydict(
            {
                "model": pa.array(list(sums), pa.int32()),
                "sums": pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64())),
            }
        )

    narrow = data.select(F.col(label).cast("double").alias("y"), "fold", "x")
    partial = narrow.mapInArrow(add_up, "model int, sums array<double>")
    each = partial.select("model", F.posexplode("sums").alias("at", "part"))
    found = {m: np.zeros(1 + width + width * width) for m in betas}
    for r in each.groupBy("model", "at").agg(F.sum("part").alias("total")).collect():
        found[r.model][r["at"]] = r.total
    return {m: (s[0], s[1 : width + 1], s[width + 1 :].reshape(width, width)) for m, s in found.items()}


def cross_validated_scores(
    train: DataFrame, expressions: Mapping[str, str], k: int = 5, label: str = "TARGET"
) -> DataFrame:
    """SK_ID_CURR, label, fold and score of every row, by the model that has not seen it."""
    data = folds(train.select("SK_ID_CURR", label, *expressions), k, label=label)
    woe = F.array(*[F.expr(sql).cast("double") for sql in expressions.values()])
    data = stage(data.select("SK_ID_CURR", label, "fold", woe.alias("x")))
    models = F.array(*[F.array(*map(F.lit, beta.tolist())) for beta in fold_models(data, k, label)])
    beta = models[F.col("fold")]
    products = F.zip_with("x", F.slice(beta, 1, len(expressions)), lambda a, b: a * b)
    margin = F.aggregate(products, beta[len(expressions)], lambda a, b: a + b)
    return data.select("SK_ID_CURR", label, "fold", (1 / (1 + F.exp(-margin))).alias("score"))


def cross_validated_auc(
    train: DataFrame, expressions: Mapping[str, str], k: int = 5, label: str = "TARGET"
) -> tuple[float, float]:
    """Mean and standard deviation of the exact AUC over ``k`` folds that keep the class shares."""
    scored = cross_validated_scores(train, expressions, k, label)
    found = rank_metrics(ranked_scores(scored, ["fold"], "score", label), ["fold"]).collect()
    aucs = [r.auc for r in found]
    return float(np.mean(aucs)), float(np.std(aucs))


def probability_of_default(scored: DataFrame, name: str = "PD") -> DataFrame:
    """Append the probability of class 1 from a fitted classifier's output."""
    return scored.withColumn(name, vector_to_array("probability")[1])


def coefficients(spark, model: PipelineModel, selected: Sequence[str]) -> DataFrame:
    """Rows of (feature, coef) of a fitted scorecard."""
    fitted = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(selected, fitted.coefficients, strict=True)]
    return spark.createDataFrame(rows, "feature string, coef double")


def points_table(
    woe: DataFrame,
    coefs: DataFrame,
    intercept: float,
    pdo: float = PDO,
    odds: float = BASE_ODDS,
    base: float = BASE_POINTS,
    anchor: bool = False,
) -> DataFrame:
    """Scorecard points per bin of the features in ``coefs``.

    ``anchor`` spreads the base points over the features, so that a customer at the base
    odds scores the base; without it points are relative.
    """
    factor = pdo / math.log(2)
    offset = base - factor * math.log(odds)
    size = with_group_totals(coefs, (), [F.count(F.lit(1)).alias("size")])
    joined = woe.where(F.col("bin") != MISSING).join(F.broadcast(size), "feature")
    points = -(F.col("coef") * F.col("woe") + F.lit(float(intercept)) / F.col("size")) * F.lit(factor)
    if anchor:
        points = points + F.lit(offset) / F.col("size")
    return joined.select(
        "feature",
        interval_label(F.col("low"), F.col("high")).alias("bin"),
        F.round("woe", 4).alias("woe"),
        F.round("iv", 4).alias("iv"),
        F.round("coef", 4).alias("lr_coef"),
        F.round(points, 1).alias("points"),
    )


def interval_label(low: Column, high: Column) -> Column:
    """Half-open interval as text; a null limit is infinite."""
    low_text = F.when(low.isNull(), "-inf").otherwise(F.format_string("%.4f", low))
    high_text = F.when(high.isNull(), "inf").otherwise(F.format_string("%.4f", high))
    return F.concat(F.lit("["), low_text, F.lit(", "), high_text, F.lit(")"))
