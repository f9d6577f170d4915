"""Early warning: what the behavioural features show months before default."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions.columns import clip, share, stack_columns
from arrears.operators.installments import DAYS_PER_MONTH
from arrears.operators.metrics import rank_metrics, ranked_scores
from arrears.operators.store import available, feature_store
from arrears.sources.staging import stage
from arrears.sources.tables import Tables

LEAD_MONTHS = (12, 9, 6, 3, 1)
THRESHOLD = 0.50

# Inputs of the early-warning model.
BEHAVIOUR_FEATURES = [
    "ins_days_late_mean",
    "ins_underpay_ratio_mean",
    "ins_pct_missed",
    "ins_pct_late",
    "ins_days_late_l3m",
    "ins_underpay_ratio_l3m",
    "ins_late_momentum",
    "cc_util_mean",
    "cc_util_l3m",
    "cc_util_trend",
    "cc_dpd_mean",
    "cc_dpd_max",
    "cc_min_pay_ratio_mean",
    "cc_balance_trend",
    "bur_delinq_rate",
    "bur_delinq_rate_12m",
    "bur_worst_status_ever",
    "bur_status_trend",
    "bur_debt_credit_ratio",
    "stress_composite",
    "n_products_delinquent",
]
# Features a snapshot takes unchanged from the store.
CARRIED_FEATURES = [
    "bur_delinq_rate",
    "bur_delinq_rate_12m",
    "bur_worst_status_ever",
    "bur_debt_credit_ratio",
    "stress_composite",
    "n_products_delinquent",
]
# Features of the stress trajectory.
STRESS_FEATURES = [
    "ins_days_late_l3m",
    "ins_underpay_ratio_l3m",
    "cc_util_l3m",
    "cc_dpd_l3m",
    "bur_delinq_rate_12m",
    "n_products_delinquent",
]
# Upper ends of the risk tiers on (0, 1].
TIERS = {"Very Low": 0.2, "Low": 0.4, "Medium": 0.6, "High": 0.8, "Critical": 1.0}

SNAPSHOT_INSTALLMENTS = ["ins_days_late_mean", "ins_underpay_ratio_mean", "ins_pct_missed", "ins_pct_late"]
SNAPSHOT_CARD = ["cc_util_mean", "cc_dpd_mean", "cc_dpd_max", "cc_balance_mean_sim"]


def _per_month(
    months: Sequence[int], seen: Mapping[int, Column], features: Mapping[str, tuple]
) -> list[Column]:
    """Each feature as of each month, as aggregates of one pass."""
    return [
        how(F.when(seen[m], value)).cast("double").alias(f"{name}_{m}")
        for m in months
        for name, (how, value) in features.items()
    ]


def installment_snapshots(months: Sequence[int] = LEAD_MONTHS) -> list[Column]:
    """Installment behaviour known ``m`` months back; delays are clipped at zero."""
    late = clip(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT"), low=F.lit(0.0))
    short = clip(1 - F.try_divide("AMT_PAYMENT", "AMT_INSTALMENT"), low=F.lit(0.0))
    seen = {m: F.col("DAYS_INSTALMENT") <= -m * DAYS_PER_MONTH for m in months}
    features = {
        "ins_days_late_mean": (F.avg, late),
        "ins_underpay_ratio_mean": (F.avg, short),
        "ins_pct_missed": (F.avg, F.when(F.col("AMT_PAYMENT") == 0, 1.0).otherwise(0.0)),
        "ins_pct_late": (F.avg, F.when(late > 0, 1.0).otherwise(0.0)),
    }
    return _per_month(months, seen, features)


def card_snapshots(months: Sequence[int] = LEAD_MONTHS) -> list[Column]:
    """Card behaviour known ``m`` months back; utilization is clipped to [0, 1]."""
    used = clip(F.try_divide("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"), F.lit(0.0), F.lit(1.0))
    seen = {m: F.col("MONTHS_BALANCE") <= -m for m in months}
    features = {
        "cc_util_mean": (F.avg, used),
        "cc_dpd_mean": (F.avg, F.col("SK_DPD")),
        "cc_dpd_max": (F.max, F.col("SK_DPD")),
        "cc_balance_mean_sim": (F.avg, F.col("AMT_BALANCE")),
    }
    return _per_month(months, seen, features)


def store_with_history(tables: Tables, months: Sequence[int] = LEAD_MONTHS) -> DataFrame:
    """The feature store with the recomputed behaviour of every month beside it.

    Features and snapshots of a raw table come from one aggregation, so each table is read
    and shuffled once.
    """
    return feature_store(
        tables, beside={"installments": installment_snapshots(months), "card_balance": card_snapshots(months)}
    )


def snapshot_features(history: DataFrame, months: Sequence[int] = LEAD_MONTHS) -> DataFrame:
    """Every customer at every snapshot: recomputed behaviour and carried features.

    ``history`` are rows of ``store_with_history``; its months become rows here.
    """
    carried = available(CARRIED_FEATURES, history)
    recomputed = SNAPSHOT_INSTALLMENTS + SNAPSHOT_CARD
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("months_before_default"),
                *[F.col(f"{name}_{m}").alias(name) for name in recomputed],
            )
            for m in months
        ]
    )
    long = history.select("SK_ID_CURR", "TARGET", *carried, F.inline(rows))
    return long.select("SK_ID_CURR", "months_before_default", "TARGET", *recomputed, *carried)


def masked_features(store: DataFrame, months: Sequence[int] = LEAD_MONTHS) -> DataFrame:
    """Snapshots without raw history: recent features become zero as months grow."""

    def hidden(column: str) -> Column | None:
        month = F.col("months_before_default")
        if "l3m" in column:
            return month >= 6
        if "l6m" in column or "trend" in column:
            return month >= 9
        return None

    rows = store.withColumn("months_before_default", F.explode(F.array(*[F.lit(m) for m in months])))
    masked = {
        c: F.when(hidden(c), F.lit(0.0)).otherwise(F.col(c))
        for c in available(BEHAVIOUR_FEATURES, store)
        if hidden(c) is not None
    }
    return rows.withColumns(masked)


def align_features(df: DataFrame, features: Sequence[str] = tuple(BEHAVIOUR_FEATURES)) -> DataFrame:
    """Exactly the model's inputs: an absent column or a missing value is zero."""
    others = [c for c in df.columns if c not in features]
    inputs = [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)).alias(c)
        for c in features
    ]
    return df.select(*others, *inputs)


def lead_time(
    scored: DataFrame,
    score: str = "score",
    label: str = "TARGET",
    month: str = "months_before_default",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Capture, flagged share, false positives and AUC at each lead time.

    ``false_alarm_rate_pct`` is the flagged share of all rows; ``false_positive_rate_pct``
    counts flagged good customers among the good ones.
    """
    scored = stage(scored.select(month, label, score))
    flagged = F.col(score) >= threshold
    bad, good = F.col(label) == 1, F.col(label) == 0

    def percent(part: Column, of: Column) -> Column:
        return F.round(share(F.count(F.when(part, 1)), of) * 100, 1)

    rates = scored.groupBy(month).agg(
        percent(flagged & bad, F.count(F.when(bad, 1))).alias("capture_rate_pct"),
        percent(flagged, F.count(F.lit(1))).alias("false_alarm_rate_pct"),
        percent(flagged & good, F.count(F.when(good, 1))).alias("false_positive_rate_pct"),
    )
    aucs = rank_metrics(ranked_scores(scored, [month], score, label), [month])
    return (
        rates.join(aucs.select(month, F.round("auc", 4).alias("auc")), month, "left")
        .withColumnRenamed(month, "months_before_default")
        .orderBy(F.desc("months_before_default"))
    )


def stress_trajectory(store: DataFrame, features: Sequence[str] = tuple(STRESS_FEATURES)) -> DataFrame:
    """Mean of each stress feature for good and bad customers and their ratio."""
    long = store.select("TARGET", stack_columns(available(list(features), store), "feature", "value"))
    means = long.groupBy("feature").agg(
        F.avg(F.when(F.col("TARGET") == 0, F.col("value"))).alias("good_mean"),
        F.avg(F.when(F.col("TARGET") == 1, F.col("value"))).alias("bad_mean"),
    )
    base = F.when(F.col("good_mean") == 0, 1.0).otherwise(F.col("good_mean"))
    return means.withColumn("ratio", F.col("bad_mean") / base)


def risk_tier(score: Column) -> Column:
    """Tier of a score in (0, 1]; a score of exactly zero has none."""
    tier = F.when(score <= 0, None)
    for name, upper in TIERS.items():
        tier = tier.when(score <= upper, name)
    return tier


def warning_flags(scored: DataFrame, score: str = "score", threshold: float = THRESHOLD) -> DataFrame:
    """Flag and tier per customer, from the unrounded score."""
    value = F.col(score)
    return scored.select(
        "SK_ID_CURR",
        "TARGET",
        F.round(value, 4).alias("ew_score"),
        F.when(value >= threshold, 1).otherwise(0).alias("ew_flag"),
        risk_tier(value).alias("risk_tier"),
    )
