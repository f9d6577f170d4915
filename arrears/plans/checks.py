"""What must hold of fitted models, as queries whose rows and counts SQL can state.

The queries of ``catalog`` that fit a model return its numbers, which SQL cannot repeat.
These fit the same models and return, per row that SQL lists or counts from the raw tables,
whether the numbers have the properties that define them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.functions.columns import stack_columns
from arrears.operators import attribution, binning, metrics, scorecard, split, store
from arrears.plans import catalog
from arrears.sources import sinks
from arrears.sources.staging import new_folder, stage

CLOSE = 1e-9


def _all(condition: Column) -> Column:
    return F.coalesce(F.bool_and(condition), F.lit(True))


def _equal(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= CLOSE


def optimal_bins_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Per feature: rows add up, and bins are few, large enough, monotone and adjoining."""
    train = stage(
        catalog._split_store(spark, sf).where("is_train").select("TARGET", *store.MODEL_FEATURES)
    )
    bins = stage(binning.optimal_bins(train, store.MODEL_FEATURES))
    size = train.count()
    filled = F.col("bin") != binning.MISSING
    in_order = Window.partitionBy("feature").orderBy("bin")
    rate = F.col("bad") / F.col("n")
    step = rate - F.lag(rate).over(in_order)
    stepped = bins.where(filled).select(
        "feature",
        "bin",
        (F.col("n") >= binning.MIN_BIN_SHARE * size).alias("large"),
        step.alias("step"),
        F.coalesce(F.lag("high").over(in_order) == F.col("low"), F.col("low").isNull()).alias("adjoins"),
        (F.col("high").isNull() == F.lead("bin").over(in_order).isNull()).alias("closed"),
    )
    shape = stepped.groupBy("feature").agg(
        (F.count(F.lit(1)) <= binning.MAX_BINS).alias("few"),
        (_all(F.col("large")) | (F.count(F.lit(1)) == 1)).alias("large"),
        (_all(F.col("step") >= -CLOSE) | _all(F.col("step") <= CLOSE)).alias("monotone"),
        _all(F.col("adjoins") & F.col("closed")).alias("adjoining"),
    )
    sums = bins.groupBy("feature").agg(
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.sum(F.when(filled, 0).otherwise(F.col("n"))).alias("n_missing"),
        _all(F.col("iv") >= 0).alias("information"),
    )
    return sums.join(shape, "feature")


def scorecard_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted scorecard is at the minimum of its penalised loss, and points follow."""
    train = catalog._modelled(spark, sf).where("is_train")
    model, bins, selected = scorecard.fit_scorecard(train, store.MODEL_FEATURES)
    fitted = model.stages[-1]
    weighted = stage(scorecard.balanced_weights(train.select("TARGET", *selected)))
    n = weighted.count()
    penalty = 1.0 / (scorecard.INVERSE_REGULARISATION * n)
    rows = scorecard.probability_of_default(model.transform(weighted)).select(
        "TARGET", "weight", (F.col("weight") * (F.col("PD") - F.col("TARGET"))).alias("g"),
        vector_to_array("features").alias("x"),
    )
    slopes = [
        F.sum(F.col("g") * F.col("x")[i]) / F.sum("weight") + F.lit(penalty * float(c))
        for i, c in enumerate(fitted.coefficients)
    ]
    flat = reduce(lambda a, b: a & b, [F.abs(s) < 1e-4 for s in slopes])
    good, bad = (F.sum(F.when(F.col("TARGET") == t, F.col("weight"))) for t in (0, 1))
    coefs = scorecard.coefficients(spark, model, selected)
    points = scorecard.points_table(bins, coefs, fitted.intercept).select(
        (F.abs(F.col("points") + (F.col("lr_coef") * F.col("woe") + fitted.intercept / len(selected))
               * (scorecard.PDO / 0.6931471805599453)) < 0.2).alias("follows")
    )
    measured = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("TARGET").alias("bad"),
        flat.alias("at_minimum"),
        (F.abs(F.sum("g") / F.sum("weight")) < 1e-4).alias("intercept_at_minimum"),
        (F.abs(good - bad) < 1e-6).alias("classes_balanced"),
    )
    return measured.withColumn("points_follow", points.agg(_all(F.col("follows"))).scalar())


def cv_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each class in each fold, and whether the AUC is that of the scores by plain SQL.

    There the AUC of a fold is the sum of its bad rows' ranks, ties sharing their ranks.
    """
    train = catalog._modelled(spark, sf).where("is_train")
    expressions = catalog._woe_inputs(train)
    scored = stage(scorecard.cross_validated_scores(train, expressions))
    mean, deviation = scorecard.cross_validated_auc(train, expressions)
    by_sql = spark.sql(
        """
        SELECT avg(auc) AS mean, stddev_pop(auc) AS sd FROM (
          SELECT (sum(CASE WHEN TARGET = 1 THEN place END) - sum(TARGET) * (sum(TARGET) + 1) / 2e0)
                 / (sum(TARGET) * sum(1 - TARGET)) AS auc
          FROM (SELECT fold, TARGET, rank() OVER (PARTITION BY fold ORDER BY score)
                       + (count(*) OVER (PARTITION BY fold, score) - 1) / 2e0 AS place FROM {scored})
          GROUP BY fold)
        """,
        scored=scored,
    ).first()
    equal = abs(by_sql.mean - mean) < CLOSE and abs(by_sql.sd - deviation) < CLOSE
    sizes = split.folds(train.select("SK_ID_CURR", "TARGET")).groupBy("TARGET", "fold")
    return sizes.agg(F.count(F.lit(1)).alias("n")).withColumn("auc_by_sql", F.lit(equal))


def challenger_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer: PD inside (0, 1), the same from the saved model, parts sum to it."""
    model, modelled = catalog._fitted_trees(spark, sf)
    folder = new_folder(spark)
    sinks.save_model(model, modelled.agg(F.count(F.lit(1)).alias("n")), folder, "challenger")
    loaded, _ = sinks.load_model(spark, folder, "challenger")
    scored = scorecard.probability_of_default(model.transform(modelled))
    again = scorecard.probability_of_default(loaded.transform(modelled), "again")
    parts = attribution.path_contributions(
        model.transform(modelled), attribution.tree_nodes(spark, model), store.MODEL_FEATURES
    )
    margin = reduce(lambda a, b: a + b, [F.col(c) for c in ("base", *store.MODEL_FEATURES)])
    return (
        scored.select(
            "SK_ID_CURR", "TARGET", "is_train", "PD", vector_to_array("rawPrediction")[1].alias("margin")
        )
        .join(again.select("SK_ID_CURR", "again"), "SK_ID_CURR")
        .join(parts.select("SK_ID_CURR", margin.alias("parts")), "SK_ID_CURR")
        .select(
            "SK_ID_CURR",
            "TARGET",
            "is_train",
            ((F.col("PD") > 0) & (F.col("PD") < 1)).alias("pd_inside"),
            (F.col("PD") == F.col("again")).alias("same_when_loaded"),
            _equal(F.col("parts"), F.col("margin")).alias("parts_sum_to_margin"),
        )
    )


def tree_importance_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Importances are the mean sizes of the parts over the test rows, largest first."""
    parts = stage(catalog.tree_attribution(spark, sf))
    ranked = attribution.global_importance(parts, store.MODEL_FEATURES, top=None)
    listed = [r.importance for r in ranked.collect()]
    direct = parts.select(stack_columns(store.MODEL_FEATURES, "feature", "part"))
    sizes = direct.groupBy("feature").agg(F.sum(F.abs("part")).alias("total"), F.count("part").alias("n"))
    matched = ranked.join(sizes, "feature").agg(
        F.max("n").alias("n_customers"),
        F.count(F.lit(1)).alias("n_features"),
        _all(_equal(F.col("importance"), F.col("total") / F.col("n"))).alias("mean_of_parts"),
    )
    return matched.withColumn("in_order", F.lit(listed == sorted(listed, reverse=True)))


def fitted_comparison_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows of both models; the AUC of the comparison is the evaluator's."""
    trees, modelled = catalog._fitted_trees(spark, sf)
    card_model, _, _ = scorecard.fit_scorecard(modelled.where("is_train"), store.MODEL_FEATURES)

    def scores(model, name: str) -> DataFrame:
        return scorecard.probability_of_default(model.transform(modelled), "score").select(
            F.lit(name).alias("model"), F.col("TARGET").alias("label"), "is_train", "score"
        )

    both = stage(scores(card_model, "Baseline").unionByName(scores(trees, "Challenger")))
    compared = metrics.model_comparison(both, "Baseline")
    tested = both.where("NOT is_train")
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    names = ("Baseline", "Challenger")
    own = [(m, float(evaluator.evaluate(tested.where(F.col("model") == m)))) for m in names]
    sizes = tested.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad"))
    return (
        sizes.join(compared, "model")
        .join(spark.createDataFrame(own, "model string, own_auc double"), "model")
        .select(
            "model",
            "n",
            "bad",
            _equal(F.col("auc"), F.col("own_auc")).alias("same_auc"),
            _equal(F.col("gini"), 2 * F.col("auc") - 1).alias("gini_follows"),
            ((F.col("ks") >= 0) & (F.col("ks") <= 1) & (F.col("psi") >= 0)).alias("in_range"),
        )
    )


def fitted_warning_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every lead time is listed, with rates that are shares of one table."""
    found = catalog.fitted_warning(spark, sf)
    rates = ("capture_rate_pct", "false_alarm_rate_pct", "false_positive_rate_pct")
    shares = reduce(lambda a, b: a & b, [F.col(c).between(0, 100) for c in rates])
    low = F.least("capture_rate_pct", "false_positive_rate_pct")
    high = F.greatest("capture_rate_pct", "false_positive_rate_pct")
    return found.select(
        "months_before_default",
        shares.alias("rates_are_shares"),
        # All flagged rows are bad or good ones, so their share lies between both rates.
        F.col("false_alarm_rate_pct").between(low - 0.1, high + 0.1).alias("flagged_between"),
        F.col("auc").between(0, 1).alias("auc_in_range"),
    )


QUERIES = [
    optimal_bins_checks,
    scorecard_checks,
    cv_checks,
    challenger_checks,
    tree_importance_checks,
    fitted_comparison_checks,
    fitted_warning_checks,
]


def queries() -> dict[str, catalog.Query]:
    return {q.__name__: q for q in QUERIES}

