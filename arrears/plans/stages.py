"""The steps of the analysis, each reading the saved tables of the earlier ones."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.operators import (
    attribution,
    binning,
    challenger,
    early_warning,
    history,
    metrics,
    policy,
    quality,
    reporting,
    scenario,
    scorecard,
    split,
    store,
)
from arrears.plans.manifests import Manifests, raw_state
from arrears.sources import sinks
from arrears.sources.staging import scope
from arrears.sources.tables import Tables, input_contract

BASELINE = "Baseline (Logistic Regression)"
CHALLENGER = "Challenger (Boosted Trees)"


@dataclass
class Run:
    """Where a run reads and writes, and the settings of its models and policy."""

    spark: SparkSession
    folder: str
    tables: Tables | None = None
    expected_rows: dict[str, int] | None = None
    trees: dict = field(default_factory=dict)
    warning_trees: dict = field(default_factory=dict)
    capacity: int = policy.CAPACITY
    # "as_of": on the store of each month; "masked": from the store alone, without raw history
    lead_time_from: str = "raw"

    def __post_init__(self):
        self.manifests = Manifests(self.spark, self.folder)
        self._stage: dict | None = None  # what the running stage has written and read

    def save(self, df: DataFrame, name: str) -> DataFrame:
        return sinks.save_table(df, self.folder, self._new_version(name))

    def save_model(self, model: PipelineModel, measured: DataFrame, name: str) -> None:
        sinks.save_model(model, measured, self.folder, self._new_version(name))

    def load(self, name: str) -> DataFrame:
        return sinks.load_table(self.spark, self.folder, self._version(name))

    def load_model(self, name: str) -> tuple[PipelineModel, DataFrame]:
        return sinks.load_model(self.spark, self.folder, self._version(name))

    def raw(self) -> Tables:
        if self.tables is None:
            raise ValueError("this step needs the raw tables")
        if self._stage:
            self._stage["raw"] = raw_state(self.tables)
        return self.tables

    def _new_version(self, name: str) -> str:
        if self._stage is None:
            return name
        self._stage["tables"][name] = self._stage["version"]
        return f"{name}/{self._stage['version']}"

    def _version(self, name: str) -> str:
        """The place of a table: of the running stage, or of the stage that published it."""
        if self._stage and name in self._stage["tables"]:
            return f"{name}/{self._stage['tables'][name]}"
        version = self.published().get(name)
        if self._stage and version:
            self._stage["inputs"][name] = version
        return f"{name}/{version}" if version else name

    def published(self) -> dict[str, str]:
        found = {}
        for stage in STAGES:
            found |= (self.manifests.current(stage) or {"tables": {}})["tables"]
        return found

    def settings(self, stage: int) -> dict:
        """What of the settings the stage depends on."""
        return {name: getattr(self, name) for name in SETTINGS.get(stage, ())}

    def outdated(self, stage: int) -> str | None:
        """Why a stage's results do not fit the inputs and settings there are; None if they do."""
        manifest = self.manifests.current(stage)
        if manifest is None:
            return "has not finished"
        if manifest["settings"] != json.loads(json.dumps(self.settings(stage))):
            return "ran with other settings"
        published = self.published()
        changed = [name for name, version in manifest["inputs"].items() if published.get(name) != version]
        if changed:
            return f"read {', '.join(sorted(changed))} before the present version"
        if manifest["raw"] and self.tables is not None and manifest["raw"] != raw_state(self.tables):
            return "read other raw tables"
        return None

    def run_stage(self, stage: int, work: Callable[[Run], list[str]]) -> list[str]:
        """Run a stage and publish its manifest; until then its last results stand."""
        self._stage = {"version": uuid4().hex, "tables": {}, "inputs": {}, "raw": {}}
        try:
            with scope(self.spark):
                saved = work(self)
            manifest = {k: self._stage[k] for k in ("tables", "inputs", "raw")}
        finally:
            self._stage = None
        self.manifests.publish(stage, manifest | {"settings": self.settings(stage)})
        return saved


def build_store(run: Run) -> list[str]:
    """Check the inputs, build the feature store and profile it."""
    contract = run.save(input_contract(run.raw(), run.expected_rows), "input_contract")
    failed = [r.table_name for r in contract.where(~F.col("ok")).collect()]
    if failed:
        raise ValueError(f"unusable input tables: {', '.join(failed)}")
    built = run.save(store.feature_store(run.raw()), "feature_store")
    profiles = {
        "fs_summary": quality.summary(built),
        "fs_completeness": quality.completeness(built),
        "fs_default_by_products": quality.default_by_products(built),
        "fs_means_by_target": quality.means_by_target(built),
        "missing_profile": quality.missing_profile(built),
        "corr_matrix": quality.correlation_matrix(built),
        "target_corr": quality.target_correlation(built),
    }
    for name, df in profiles.items():
        run.save(df, name)
    top = [r.feature for r in quality.target_correlation(built, top=3).collect()]
    run.save(quality.class_histogram(built, top), "class_histogram")
    run.save(split.stratified_split(built), "split_store")
    return ["input_contract", "feature_store", *profiles, "class_histogram", "split_store"]


def _scores(model: PipelineModel, customers: DataFrame, name: str) -> DataFrame:
    return scorecard.probability_of_default(model.transform(customers), "score").select(
        F.lit(name).alias("model"), "SK_ID_CURR", F.col("TARGET").alias("label"), "is_train", "score"
    )


def _sample_metrics(scores: DataFrame) -> DataFrame:
    sample = F.when(F.col("is_train"), "train").otherwise("test")
    ranked = metrics.ranked_scores(scores.withColumn("sample", sample), ["sample"])
    return metrics.rank_metrics(ranked, ["sample"])


def fit_scorecard(run: Run) -> list[str]:
    """Bin, fit the points scorecard and measure it."""
    customers = run.load("split_store")
    features = store.available(store.MODEL_FEATURES, customers)
    model, bins, selected = scorecard.fit_scorecard(customers.where("is_train"), features)
    coefs = scorecard.coefficients(run.spark, model, selected)
    scores = run.save(_scores(model, customers, BASELINE), "scorecard_scores")
    measured = run.save(_sample_metrics(scores), "scorecard_metrics")
    run.save_model(model, measured, "scorecard_model")
    drift = metrics.psi(metrics.psi_bins(scores))
    mean, deviation = scorecard.cross_validated_auc(
        customers.where("is_train"), binning.woe_expressions(bins, selected)
    )
    folds = [(float(mean), float(deviation))]
    results = {
        "scorecard_cv": run.spark.createDataFrame(folds, "mean_auc double, sd_auc double"),
        "woe_table": bins,
        "iv_table": binning.information_values(bins),
        "scorecard_table": scorecard.points_table(bins, coefs, model.stages[-1].intercept),
        "scorecard_checks": metrics.fit_checks(measured),
        "scorecard_psi": drift.withColumn("status", metrics.psi_status(F.col("psi"))),
        "scorecard_density": metrics.score_density(scores),
    }
    for name, df in results.items():
        run.save(df, name)
    return ["scorecard_scores", "scorecard_metrics", *results]


def fit_challenger(run: Run) -> list[str]:
    """Fit the boosted trees and compare both models on the test rows."""
    customers = run.load("split_store")
    features = store.available(store.MODEL_FEATURES, customers)
    model = challenger.fit_boosted_trees(customers.where("is_train"), features, run.trees)
    scores = run.save(_scores(model, customers, CHALLENGER), "challenger_scores")
    measured = _sample_metrics(scores)
    run.save_model(model, measured, "challenger_model")
    inputs = model.transform(customers.where(~F.col("is_train")))
    parts = run.save(
        attribution.path_contributions(inputs, attribution.tree_nodes(run.spark, model), features),
        "attributions",
    )
    pds = scores.where(~F.col("is_train")).select("SK_ID_CURR", F.col("score").alias("PD"))
    both = run.load("scorecard_scores").unionByName(scores)
    comparison = run.save(metrics.model_comparison(both, BASELINE), "model_comparison")
    tested = both.where(~F.col("is_train"))
    results = {
        "importance": attribution.global_importance(parts, features),
        "riskiest_customer": attribution.explain_riskiest(parts, pds, features),
        "model_health": metrics.model_health(comparison),
        "gain_curve": metrics.gain_curve(tested, ["model"]),
        "roc_points": metrics.roc_points(metrics.ranked_scores(tested, ["model"]), ["model"]),
    }
    for name, df in results.items():
        run.save(df, name)
    return ["challenger_scores", "attributions", "model_comparison", *results]


def warn_early(run: Run) -> list[str]:
    """Fit the behaviour-only model, measure its lead time and flag customers."""
    customers = run.load("split_store")
    features = store.available(early_warning.BEHAVIOUR_FEATURES, customers)
    settings = {**challenger.EARLY_WARNING, **run.warning_trees}
    model = challenger.fit_boosted_trees(
        customers.where("is_train"), features, settings, flag_missing=False
    )
    tested = customers.where(~F.col("is_train"))
    if run.lead_time_from == "masked":
        snapshots = early_warning.masked_features(tested)
    elif run.lead_time_from == "as_of":
        earlier = history.store_as_of_months(run.raw())
        snapshots = earlier.join(tested.select("SK_ID_CURR"), "SK_ID_CURR", "left_semi")
    else:
        beside = early_warning.store_with_history(run.raw())
        listed = beside.join(tested.select("SK_ID_CURR"), "SK_ID_CURR", "left_semi")
        snapshots = early_warning.snapshot_features(listed)
    aligned = early_warning.align_features(snapshots, features)
    seen = scorecard.probability_of_default(model.transform(aligned), "score")
    scored = scorecard.probability_of_default(model.transform(customers), "score")
    results = {
        "lead_time_results": early_warning.lead_time(seen).withColumn(
            "features_from", F.lit(run.lead_time_from)
        ),
        "stress_trajectory": early_warning.stress_trajectory(customers),
        "early_warning_flags": early_warning.warning_flags(scored),
    }
    for name, df in results.items():
        run.save(df, name)
    return list(results)


def prioritise(run: Run) -> list[str]:
    """Rank customers by expected loss and compare the calling strategies."""
    scores = run.load("challenger_scores").select("SK_ID_CURR", F.col("score").alias("PD"))
    customers = run.load("feature_store").join(scores, "SK_ID_CURR")
    frame = policy.priority_frame(customers, keep=["NAME_CONTRACT_TYPE"])
    flagged = policy.attach_flags(frame, run.load("early_warning_flags"))
    priority = run.save(flagged, "priority")
    outcome = run.save(policy.evaluate_strategies(priority, run.capacity), "policy_metrics")
    results = {
        "policy_gain": policy.policy_gain(outcome),
        "recovery_curve": policy.recovery_curve(priority),
        "priority_list": policy.priority_list(priority),
        "loss_sample": policy.loss_sample(priority),
    }
    for name, df in results.items():
        run.save(df, name)
    return ["priority", "policy_metrics", *results]


def scenarios(run: Run) -> list[str]:
    priority, outcome = run.load("priority"), run.load("policy_metrics")
    results = {
        "scenario_linear": scenario.linear_scenario(outcome, run.capacity, base_capacity=run.capacity),
        "scenario_grid": scenario.scenario_grid(priority),
        "priority_top": reporting.top_of_list(run.load("priority_list")),
    }
    for name, df in results.items():
        run.save(df, name)
    return list(results)


def report(run: Run) -> list[str]:
    priority, ranked = run.load("priority"), run.load("priority_list")
    flags = run.load("early_warning_flags")
    results = {
        "total_el": reporting.total_expected_loss(priority),
        "recovery_at_capacity": reporting.recovery_at_capacity(priority, run.capacity),
        "capture_at_capacity": reporting.capture_at_capacity(priority, run.capacity),
        "tier_summary": reporting.tier_summary(priority),
        "pd_by_tier": reporting.pd_by_tier(priority),
        "call_list": reporting.call_list(policy.attach_flags(ranked, flags)),
        "portfolio_kpis": reporting.portfolio_kpis(priority, run.capacity),
        "customer_dimension": reporting.customer_dimension(run.load("feature_store"), ranked, flags),
    }
    for name, df in results.items():
        run.save(df, name)
    return list(results)


STAGES: dict[int, Callable[[Run], list[str]]] = {
    1: build_store,
    2: fit_scorecard,
    3: fit_challenger,
    4: warn_early,
    5: prioritise,
    6: scenarios,
    7: report,
}


# The fields of a run that each stage depends on.
SETTINGS: dict[int, tuple[str, ...]] = {
    1: ("expected_rows",),
    3: ("trees",),
    4: ("warning_trees", "lead_time_from"),
    5: ("capacity",),
    6: ("capacity",),
    7: ("capacity",),
}


def run_stages(
    run: Run,
    only: int | None = None,
    start: int = 1,
    resume: bool = False,
    stages: Mapping[int, Callable[[Run], list[str]]] | None = None,
) -> dict[int, list[str]]:
    """Run one stage, or all from ``start`` on; returns the tables each stage saved.

    A start after the first stage is refused if an earlier one has not finished, or has read
    or been set otherwise than now. ``resume`` runs those stages that do not fit, and all
    whose inputs they change. What a stage has staged on its way is removed at its end.
    """
    stages = stages or STAGES
    saved = {}
    if only is None and not resume:
        for k in stages:
            reason = run.outdated(k) if k < start else None
            if reason:
                raise ValueError(f"stage {k} {reason}; run it, or resume")
    for k in [only] if only is not None else stages:
        if only is not None or (run.outdated(k) if resume else k >= start):
            saved[k] = run.run_stage(k, stages[k])
    return saved
