"""Every operator as a query over the test tables.

Model scores come from fixed formulas wherever the operator itself does not fit a model,
so that the same query can be written in SQL. Doubles are rounded at the very end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.operators import (
    attribution,
    binning,
    bureau,
    card,
    challenger,
    early_warning,
    history,
    installments,
    metrics,
    policy,
    quality,
    reporting,
    scenario,
    scorecard,
    split,
    store,
)
from arrears.plans import stages
from arrears.sources import buckets, sinks, tables, tpch
from arrears.sources.staging import new_folder, stage

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values shared with the SQL form of the queries.
CUTS = {
    "ins_days_late_mean": [0.0, 2.0, 4.0, 6.0, 8.0, 10.0],
    "ins_pct_late": [0.3, 0.45, 0.55, 0.65],
    "cc_util_mean": [0.15, 0.3, 0.6],
    "bur_debt_credit_ratio": [0.05, 0.125, 0.2, 0.275],
    "bur_delinq_rate": [0.25, 0.375, 0.45],
    "n_products_delinquent": [1.0, 2.0, 3.0],
}
FINE_CUTS = {
    "ins_days_late_mean": [i / 4 for i in range(-8, 56)],
    "ins_pct_late": [i / 64 for i in range(1, 64)],
    "bur_debt_credit_ratio": [i / 128 for i in range(1, 51)],
    "cc_util_mean": [i / 32 for i in range(1, 40)],
    "bur_delinq_rate": [i / 64 for i in range(1, 64)],
}
COEFS = {"ins_days_late_mean": -0.8, "ins_pct_late": -0.55, "bur_debt_credit_ratio": -0.35}
INTERCEPT = -2.4
HISTOGRAM_FEATURES = ["ins_days_late_mean", "ins_pct_late", "bur_debt_credit_ratio"]
AS_OF_MONTHS = 3
EXPECTED_ROWS = {"application": 1500, "bureau": 1}
SAMPLE = 500


# Digits kept in results: more where values are short decimals and a tie could occur,
# fewer for large sums.
DIGITS = 9
DIGITS_OF = {
    "bur_amt_overdue_sum": 6,
    "cc_drawings_trend": 10,
    "stress_composite": 11,
    "cc_util_mean": 11,
    "cc_util_max": 11,
    "cc_util_l3m": 11,
    "ins_underpay_ratio_mean": 11,
    "ins_underpay_ratio_l3m": 11,
    "ins_underpay_ratio_l6m": 11,
    "EAD": 8,
    "expected_loss": 8,
    "recovery_if_called": 8,
}


def rounded(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Round every double column; adding zero drops the sign of a negative zero."""
    return df.withColumns(
        {
            f.name: F.round(f.name, digits or DIGITS_OF.get(f.name, DIGITS)) + F.lit(0.0)
            for f in df.schema.fields
            if isinstance(f.dataType, T.DoubleType)
        }
    )


def _raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tpch.tables(spark, sf, [name])[name]


def _bureau(spark: SparkSession, sf: str) -> list[DataFrame]:
    return list(tpch.tables(spark, sf, ["bureau", "bureau_balance"]).values())


def _store(spark: SparkSession, sf: str, as_of: int = 0) -> DataFrame:
    return store.feature_store(tpch.tables(spark, sf), as_of)


def _logistic(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def baseline_score() -> Column:
    delay = F.coalesce("ins_days_late_mean", F.lit(0.0))
    late = F.coalesce("ins_pct_late", F.lit(0.0))
    return F.round(_logistic(F.lit(0.5) * delay / 5 + late - 1), 3)


def challenger_score() -> Column:
    delinquent = F.coalesce("bur_delinq_rate", F.lit(0.0))
    late = F.coalesce("ins_pct_late", F.lit(0.0))
    return F.round(_logistic(2 * delinquent + late - F.lit(1.5)), 3)


def warning_score() -> Column:
    margin = (
        F.lit(0.1) * F.col("ins_days_late_mean")
        + 2 * F.col("ins_pct_late")
        + F.lit(1.5) * F.col("cc_util_mean")
        + F.lit(0.2) * F.col("cc_dpd_mean")
        - F.lit(1.5)
    )
    return F.round(_logistic(margin), 4)


def masked_score() -> Column:
    margin = (
        F.lit(0.2) * F.col("ins_days_late_l3m")
        + F.col("ins_pct_late")
        + 50 * F.col("bur_status_trend")
        + F.col("cc_util_l3m")
        - F.lit(0.5)
    )
    return F.round(_logistic(margin), 4)


def _staged_store(spark: SparkSession, sf: str) -> DataFrame:
    """The store, written once for queries that use it more than once."""
    return stage(_store(spark, sf))


def _split_store(spark: SparkSession, sf: str) -> DataFrame:
    """The store with ``is_train``: the one split of all queries."""
    return split.stratified_split(_staged_store(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return _split_store(spark, sf).select(
        "SK_ID_CURR", F.col("TARGET").alias("label"), baseline_score().alias("score"), "is_train"
    )


def _by_sample(spark: SparkSession, sf: str) -> DataFrame:
    sample = F.when(F.col("is_train"), "train").otherwise("test")
    return _scored(spark, sf).withColumn("sample", sample)


def _two_models(spark: SparkSession, sf: str) -> DataFrame:
    models = F.array(
        F.struct(F.lit("Baseline").alias("model"), baseline_score().alias("score")),
        F.struct(F.lit("Challenger").alias("model"), challenger_score().alias("score")),
    )
    return _split_store(spark, sf).select(
        "SK_ID_CURR", F.col("TARGET").alias("label"), "is_train", F.inline(models)
    )


def _priority_of(customers: DataFrame) -> DataFrame:
    scored = customers.select(
        "SK_ID_CURR",
        "TARGET",
        "NAME_CONTRACT_TYPE",
        "app_loan_amount",
        baseline_score().alias("PD"),
    )
    return policy.priority_frame(scored, keep=["NAME_CONTRACT_TYPE"])


def _flags_of(customers: DataFrame) -> DataFrame:
    behaviour = customers.select("SK_ID_CURR", "TARGET", *early_warning.BEHAVIOUR_FEATURES)
    aligned = early_warning.align_features(behaviour)
    return early_warning.warning_flags(aligned.withColumn("score", warning_score()))


def _priority(spark: SparkSession, sf: str) -> DataFrame:
    return _priority_of(_store(spark, sf))


def _dimension(spark: SparkSession, sf: str) -> DataFrame:
    customers = _staged_store(spark, sf)
    return policy.attach_flags(_priority_of(customers), _flags_of(customers))


def _woe_of(customers: DataFrame) -> DataFrame:
    train = customers.where("is_train").select("TARGET", *CUTS)
    return binning.with_limits(binning.woe_table(binning.bin_counts(train, CUTS)), CUTS)


def _woe(spark: SparkSession, sf: str) -> DataFrame:
    return _woe_of(_split_store(spark, sf))


def _woe_values_of(customers: DataFrame) -> DataFrame:
    rows = stage(customers.select("SK_ID_CURR", "TARGET", "is_train", *CUTS))
    return binning.woe_transform(rows.drop("TARGET", "is_train"), _woe_of(rows), list(CUTS))


def _woe_values(spark: SparkSession, sf: str) -> DataFrame:
    return _woe_values_of(_split_store(spark, sf))


def _contributions(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.linear_contributions(_woe_values(spark, sf), COEFS)


def _coefs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(COEFS.items()), "feature string, coef double")


# --- inputs -----------------------------------------------------------------------------


def input_contract(spark: SparkSession, sf: str) -> DataFrame:
    return tables.input_contract(tpch.tables(spark, sf))


def input_contract_expected(spark: SparkSession, sf: str) -> DataFrame:
    """The input check where some tables must have a given number of rows."""
    return tables.input_contract(tpch.tables(spark, sf), EXPECTED_ROWS)


def csv_store(spark: SparkSession, sf: str) -> DataFrame:
    """The feature store from CSV exports of all five tables."""
    folder = new_folder(spark)
    for name, df in tpch.tables(spark, sf).items():
        sinks.export_csv(df, folder, tables.FILES[name])
    return rounded(store.feature_store(tables.read_tables(spark, folder)))


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Installment features from a CSV export of the installments."""
    raw = _raw(spark, sf, "installments")
    path = sinks.export_csv(raw, new_folder(spark), "installments_payments")
    return rounded(installments.installment_features(tables.read_csv(spark, path, "installments")))


def saved_store(spark: SparkSession, sf: str) -> DataFrame:
    """The feature store as the next step reads it back."""
    return rounded(sinks.save_table(_store(spark, sf), new_folder(spark), "feature_store"))


def bucketed_store(spark: SparkSession, sf: str) -> DataFrame:
    """The feature store from raw tables that are kept in buckets of their keys."""
    folder = new_folder(spark)
    buckets.write_bucketed(tpch.tables(spark, sf), folder)
    return rounded(store.feature_store(buckets.read_bucketed(spark, folder)))


def resumed_run(spark: SparkSession, sf: str) -> DataFrame:
    """The priority list of a run that broke off between two tables and was resumed."""
    broken = []

    def build(run: stages.Run) -> list[str]:
        run.save(store.feature_store(run.raw()), "feature_store")
        return ["feature_store"]

    def rank(run: stages.Run) -> list[str]:
        frame = run.save(_priority_of(run.load("feature_store")), "priority")
        if not broken:
            broken.append(True)
            raise InterruptedError
        run.save(policy.priority_list(frame), "priority_list")
        return ["priority", "priority_list"]

    run = stages.Run(spark, new_folder(spark), tpch.tables(spark, sf))
    steps = {1: build, 2: rank}
    try:
        stages.run_stages(run, stages=steps)
    except InterruptedError:
        redone = stages.run_stages(run, resume=True, stages=steps)
        if list(redone) != [2]:
            raise RuntimeError("only the stage that broke off had to run again") from None
    return rounded(run.load("priority_list"))


# --- feature families -------------------------------------------------------------------


def installment_base(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(installments.installment_base(_raw(spark, sf, "installments")))


def ins_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(installments.installment_features(_raw(spark, sf, "installments")))


def card_base(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(card.card_base(_raw(spark, sf, "card_balance")))


def cc_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(card.card_features(_raw(spark, sf, "card_balance")))


def bureau_months(spark: SparkSession, sf: str) -> DataFrame:
    return bureau.bureau_months(*_bureau(spark, sf))


def bureau_status(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(bureau.bureau_status(*_bureau(spark, sf)))


def bureau_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(bureau.bureau_accounts(_raw(spark, sf, "bureau")))


def bur_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(bureau.bureau_features(*_bureau(spark, sf)))


def feature_store(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_store(spark, sf))


def feature_store_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_store(spark, sf, AS_OF_MONTHS))


def store_as_of_months(spark: SparkSession, sf: str) -> DataFrame:
    """The store as of every lead month, from one pass over the raw tables."""
    return rounded(history.store_as_of_months(tpch.tables(spark, sf)))


# --- checks and profiles ----------------------------------------------------------------


def fs_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.summary(_store(spark, sf))


def fs_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.completeness(_store(spark, sf))


def fs_default_by_products(spark: SparkSession, sf: str) -> DataFrame:
    return quality.default_by_products(_store(spark, sf))


def fs_means_by_target(spark: SparkSession, sf: str) -> DataFrame:
    return quality.means_by_target(_store(spark, sf))


def missing_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.missing_profile(_store(spark, sf)))


def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.correlation_matrix(_store(spark, sf)))


def target_corr(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.target_correlation(_store(spark, sf)))


def class_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.class_histogram(_store(spark, sf), HISTOGRAM_FEATURES))


def stress_histogram(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.class_histogram(_store(spark, sf), early_warning.STRESS_FEATURES, bins=40)
    return rounded(found)


# --- scorecard --------------------------------------------------------------------------


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.stratified_split(_store(spark, sf).select("SK_ID_CURR", "TARGET"))


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stratified_split(spark, sf).groupBy("TARGET", "is_train").agg(F.count(F.lit(1)).alias("n"))


def cv_folds(spark: SparkSession, sf: str) -> DataFrame:
    return split.folds(_store(spark, sf).select("SK_ID_CURR", "TARGET"))


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(challenger.class_weights(_split_store(spark, sf).where("is_train")))


def woe_iv(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_woe(spark, sf))


def iv_rank(spark: SparkSession, sf: str) -> DataFrame:
    return binning.information_values(_woe(spark, sf))


def iv_selection(spark: SparkSession, sf: str) -> DataFrame:
    return binning.select_by_iv(iv_rank(spark, sf))


def woe_transform(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_woe_values(spark, sf))


def scorecard_points(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.points_table(_woe(spark, sf), _coefs(spark), INTERCEPT)


def scorecard_points_anchored(spark: SparkSession, sf: str) -> DataFrame:
    return scorecard.points_table(_woe(spark, sf), _coefs(spark), INTERCEPT, anchor=True)


def tree_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Leaves of a tree per feature over fixed fine cells."""
    train = _split_store(spark, sf).where("is_train").select("TARGET", *FINE_CUTS)
    return binning.tree_bins(binning.bin_counts(train, FINE_CUTS), FINE_CUTS)


def turning_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Merged bins whose trend may turn once."""
    train = stage(_split_store(spark, sf).where("is_train").select("TARGET", *store.MODEL_FEATURES))
    return rounded(binning.optimal_bins(train, store.MODEL_FEATURES, turns=1))


def optimal_bins(spark: SparkSession, sf: str) -> DataFrame:
    train = stage(_split_store(spark, sf).where("is_train").select("TARGET", *store.MODEL_FEATURES))
    return rounded(binning.optimal_bins(train, store.MODEL_FEATURES))


def _modelled(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["SK_ID_CURR", "TARGET", "app_loan_amount", *store.MODEL_FEATURES]
    return stage(split.stratified_split(stage(_store(spark, sf).select(*wanted))))


def scorecard_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Points table of a fitted scorecard."""
    train = _modelled(spark, sf).where("is_train")
    model, bins, selected = scorecard.fit_scorecard(train, store.MODEL_FEATURES)
    coefs = scorecard.coefficients(spark, model, selected)
    return scorecard.points_table(bins, coefs, model.stages[-1].intercept)


def _woe_inputs(train: DataFrame) -> dict[str, str]:
    bins, selected = scorecard.informative_bins(train, store.MODEL_FEATURES)
    return binning.woe_expressions(bins, selected)


def cv_auc(spark: SparkSession, sf: str) -> DataFrame:
    train = _modelled(spark, sf).where("is_train")
    mean, deviation = scorecard.cross_validated_auc(train, _woe_inputs(train))
    return spark.createDataFrame([(mean, deviation)], "mean_auc double, sd_auc double")


# --- model metrics ----------------------------------------------------------------------


def auc_gini_ks(spark: SparkSession, sf: str) -> DataFrame:
    ranked = metrics.ranked_scores(_by_sample(spark, sf), ["sample"])
    return rounded(metrics.rank_metrics(ranked, ["sample"]))


def ks_curve(spark: SparkSession, sf: str) -> DataFrame:
    ranked = metrics.ranked_scores(_by_sample(spark, sf), ["sample"])
    return rounded(metrics.ks_curve(ranked, ["sample"]))


def ks_position(spark: SparkSession, sf: str) -> DataFrame:
    ranked = metrics.ranked_scores(_by_sample(spark, sf), ["sample"])
    return rounded(metrics.ks_position(ranked, ["sample"]))


def roc_points(spark: SparkSession, sf: str) -> DataFrame:
    tested = _two_models(spark, sf).where(~F.col("is_train"))
    return rounded(metrics.roc_points(metrics.ranked_scores(tested, ["model"]), ["model"]))


def psi_bins(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.psi_bins(_scored(spark, sf)))


def psi(spark: SparkSession, sf: str) -> DataFrame:
    found = metrics.psi(metrics.psi_bins(_scored(spark, sf)))
    return rounded(found.withColumn("psi_status", metrics.psi_status(F.col("psi"))))


def fit_checks(spark: SparkSession, sf: str) -> DataFrame:
    ranked = metrics.ranked_scores(_by_sample(spark, sf), ["sample"])
    return rounded(metrics.fit_checks(metrics.rank_metrics(ranked, ["sample"])))


def score_density(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.score_density(_scored(spark, sf)))


def gain_curve(spark: SparkSession, sf: str) -> DataFrame:
    tested = _two_models(spark, sf).where(~F.col("is_train"))
    return rounded(metrics.gain_curve(tested, ["model"]))


def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.model_comparison(_two_models(spark, sf), "Baseline"))


def model_health(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.model_health(model_comparison(spark, sf))


# --- challenger and attribution ---------------------------------------------------------


def _fitted_trees(spark: SparkSession, sf: str):
    modelled = _modelled(spark, sf)
    model = challenger.fit_boosted_trees(modelled.where("is_train"), store.MODEL_FEATURES)
    return model, modelled


def challenger_pd(spark: SparkSession, sf: str) -> DataFrame:
    """PD of every customer from the fitted challenger, saved and loaded in between."""
    model, modelled = _fitted_trees(spark, sf)
    folder = new_folder(spark)
    sizes = modelled.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"))
    sinks.save_model(model, sizes, folder, "challenger")
    loaded, _ = sinks.load_model(spark, folder, "challenger")
    scored = scorecard.probability_of_default(loaded.transform(modelled))
    return rounded(scored.select("SK_ID_CURR", "TARGET", "is_train", "PD"))


def fitted_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted scorecard against fitted challenger on the test rows."""
    trees, modelled = _fitted_trees(spark, sf)
    card_model, _, _ = scorecard.fit_scorecard(modelled.where("is_train"), store.MODEL_FEATURES)

    def scores(model, name: str) -> DataFrame:
        return scorecard.probability_of_default(model.transform(modelled), "score").select(
            F.lit(name).alias("model"), "SK_ID_CURR", F.col("TARGET").alias("label"), "is_train", "score"
        )

    both = scores(card_model, "Baseline").unionByName(scores(trees, "Challenger"))
    return rounded(metrics.model_health(metrics.model_comparison(both, "Baseline")))


def tree_attribution(spark: SparkSession, sf: str) -> DataFrame:
    model, modelled = _fitted_trees(spark, sf)
    nodes = attribution.tree_nodes(spark, model)
    tested = model.transform(modelled.where(~F.col("is_train")))
    return rounded(attribution.path_contributions(tested, nodes, store.MODEL_FEATURES))


def tree_importance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(attribution.global_importance(tree_attribution(spark, sf), store.MODEL_FEATURES))


def linear_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_contributions(spark, sf))


def attribution_importance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(attribution.global_importance(_contributions(spark, sf), list(COEFS)))


def explain_riskiest(spark: SparkSession, sf: str) -> DataFrame:
    customers = _split_store(spark, sf)
    scores = customers.select("SK_ID_CURR", baseline_score().alias("PD"))
    parts = attribution.linear_contributions(_woe_values_of(customers), COEFS)
    return rounded(attribution.explain_riskiest(parts, scores, list(COEFS)))


# --- early warning ----------------------------------------------------------------------


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return early_warning.snapshot_features(early_warning.store_with_history(tpch.tables(spark, sf)))


def snapshot_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_snapshots(spark, sf))


def aligned_features(spark: SparkSession, sf: str) -> DataFrame:
    aligned = early_warning.align_features(_snapshots(spark, sf))
    return rounded(aligned.drop(*early_warning.SNAPSHOT_CARD[-1:]))


def lead_time(spark: SparkSession, sf: str) -> DataFrame:
    history = early_warning.store_with_history(tpch.tables(spark, sf))
    tested = split.stratified_split(stage(history)).where("NOT is_train")
    seen = early_warning.snapshot_features(tested)
    aligned = early_warning.align_features(seen)
    scored = aligned.select("months_before_default", "TARGET", warning_score().alias("score"))
    return early_warning.lead_time(scored)


def lead_time_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Lead times on the store as it was in each month."""
    raw = tpch.tables(spark, sf)
    tested = split.stratified_split(stage(raw["application"].select("SK_ID_CURR", "TARGET").dropna()))
    ids = tested.where("NOT is_train").select("SK_ID_CURR")
    seen = history.store_as_of_months(raw).join(ids, "SK_ID_CURR", "left_semi")
    inputs = seen.select(history.MONTH, "TARGET", *early_warning.BEHAVIOUR_FEATURES)
    aligned = early_warning.align_features(inputs)
    return early_warning.lead_time(aligned.withColumn("score", warning_score()))


def lead_time_masked(spark: SparkSession, sf: str) -> DataFrame:
    tested = _split_store(spark, sf).where("NOT is_train")
    behaviour = tested.select("SK_ID_CURR", "TARGET", *early_warning.BEHAVIOUR_FEATURES)
    masked = early_warning.masked_features(behaviour)
    aligned = early_warning.align_features(masked)
    scored = aligned.select("months_before_default", "TARGET", masked_score().alias("score"))
    return early_warning.lead_time(scored)


def stress_trajectory(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(early_warning.stress_trajectory(_store(spark, sf)))


def warning_flags(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_flags_of(_store(spark, sf)))


def fitted_warning(spark: SparkSession, sf: str) -> DataFrame:
    """Lead times of a fitted behaviour-only model on the test rows."""
    history = early_warning.store_with_history(tpch.tables(spark, sf))
    customers = stage(split.stratified_split(stage(history)))
    model = challenger.fit_boosted_trees(
        customers.where("is_train"),
        early_warning.BEHAVIOUR_FEATURES,
        challenger.EARLY_WARNING,
        flag_missing=False,
    )
    tested = customers.where(~F.col("is_train"))
    aligned = early_warning.align_features(early_warning.snapshot_features(tested))
    scored = scorecard.probability_of_default(model.transform(aligned), "score")
    return early_warning.lead_time(scored)


# --- prioritisation ---------------------------------------------------------------------


def expected_loss(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_dimension(spark, sf))


def strategy_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(policy.evaluate_strategies(_priority(spark, sf)), 2)


def policy_gain(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(policy.policy_gain(policy.evaluate_strategies(_priority(spark, sf))), 2)


def recovery_curve(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(policy.recovery_curve(_priority(spark, sf)), 4)


def priority_list(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(policy.priority_list(_priority(spark, sf)))


def loss_sample(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(policy.loss_sample(_priority(spark, sf)))


def loss_sample_500(spark: SparkSession, sf: str) -> DataFrame:
    """A sample smaller than the test tables, so that the cut shows."""
    return rounded(policy.loss_sample(_priority(spark, sf), SAMPLE))


def recovery_curve_whole(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(policy.recovery_curve(_priority(spark, sf), end=None), 4)


# --- scenarios and reports --------------------------------------------------------------


def scenario_linear(spark: SparkSession, sf: str) -> DataFrame:
    base = policy.evaluate_strategies(_priority(spark, sf))
    return rounded(scenario.linear_scenario(base, capacity=350, cost=120.0, effectiveness=0.25), 2)


def scenario_grid(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scenario.scenario_grid(_priority(spark, sf)), 2)


def priority_top1000(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reporting.top_of_list(policy.priority_list(_priority(spark, sf))))


def total_el(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reporting.total_expected_loss(_priority(spark, sf)), 4)


def recovery_at_capacity(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reporting.recovery_at_capacity(_priority(spark, sf)), 4)


def capture_at_capacity(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reporting.capture_at_capacity(_priority(spark, sf)))


def tier_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reporting.tier_summary(_dimension(spark, sf)), 4)


def pd_by_tier(spark: SparkSession, sf: str) -> DataFrame:
    return reporting.pd_by_tier(_dimension(spark, sf))


def top20(spark: SparkSession, sf: str) -> DataFrame:
    customers = _staged_store(spark, sf)
    ranked = policy.priority_list(_priority_of(customers))
    return rounded(reporting.call_list(policy.attach_flags(ranked, _flags_of(customers))))


def portfolio_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reporting.portfolio_kpis(_priority(spark, sf)), 4)


def customer_dimension(spark: SparkSession, sf: str) -> DataFrame:
    customers = _staged_store(spark, sf)
    ranked = policy.priority_list(_priority_of(customers))
    return rounded(reporting.customer_dimension(customers, ranked, _flags_of(customers)))


QUERIES: Sequence[Query] = [
    input_contract,
    input_contract_expected,
    csv_round_trip,
    csv_store,
    saved_store,
    bucketed_store,
    resumed_run,
    installment_base,
    ins_features,
    card_base,
    cc_features,
    bureau_months,
    bureau_status,
    bureau_accounts,
    bur_features,
    feature_store,
    feature_store_as_of,
    store_as_of_months,
    fs_summary,
    fs_completeness,
    fs_default_by_products,
    fs_means_by_target,
    missing_profile,
    corr_matrix,
    target_corr,
    class_histogram,
    stress_histogram,
    stratified_split,
    split_counts,
    cv_folds,
    class_weights,
    woe_iv,
    iv_rank,
    iv_selection,
    woe_transform,
    scorecard_points,
    scorecard_points_anchored,
    tree_bins,
    optimal_bins,
    turning_bins,
    scorecard_fit,
    cv_auc,
    auc_gini_ks,
    ks_curve,
    ks_position,
    roc_points,
    psi_bins,
    psi,
    fit_checks,
    score_density,
    gain_curve,
    model_comparison,
    model_health,
    challenger_pd,
    fitted_comparison,
    tree_attribution,
    tree_importance,
    linear_attribution,
    attribution_importance,
    explain_riskiest,
    snapshot_features,
    aligned_features,
    lead_time,
    lead_time_as_of,
    lead_time_masked,
    stress_trajectory,
    warning_flags,
    fitted_warning,
    expected_loss,
    strategy_metrics,
    policy_gain,
    recovery_curve,
    priority_list,
    loss_sample,
    loss_sample_500,
    recovery_curve_whole,
    scenario_linear,
    scenario_grid,
    priority_top1000,
    total_el,
    recovery_at_capacity,
    capture_at_capacity,
    tier_summary,
    pd_by_tier,
    top20,
    portfolio_kpis,
    customer_dimension,
]


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in QUERIES}
