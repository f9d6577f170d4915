"""Installment features: how late and how short customers pay their term loans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30
LAST_3_MONTHS = -91
LAST_6_MONTHS = -182


def _base_columns(as_of: int) -> tuple[Column, list[Column]]:
    """Which rows belong to the base, and its columns."""
    shift = as_of * DAYS_PER_MONTH
    due = F.col("DAYS_INSTALMENT") + shift
    paid_on = F.col("DAYS_ENTRY_PAYMENT") + shift
    paid = F.col("AMT_PAYMENT")
    if as_of:
        # A payment without a day stays; only one dated after the snapshot is hidden.
        known = F.col("DAYS_ENTRY_PAYMENT").isNull() | (paid_on <= 0)
        paid, paid_on = F.when(known, paid), F.when(known, paid_on)
    past = (F.col("DAYS_INSTALMENT") <= -shift) & (F.col("AMT_INSTALMENT") >= 0)
    return past, [
        due.alias("DAYS_INSTALMENT"),
        (paid_on - due).alias("days_late"),
        F.greatest(F.lit(0.0), 1 - F.try_divide(paid, F.col("AMT_INSTALMENT"))).alias("underpay_ratio"),
        F.when(paid == 0, 1).otherwise(0).alias("is_missed"),
    ]


def installment_base(installments: DataFrame, as_of: int = 0) -> DataFrame:
    """Past-due-date instalments with delay, shortfall and missed flag.

    ``as_of`` looks from that many months back: offsets move, later due dates drop out,
    and payments booked after that day are not known yet.
    """
    past, columns = _base_columns(as_of)
    return installments.where(past).select("SK_ID_CURR", "SK_ID_PREV", "NUM_INSTALMENT_NUMBER", *columns)


def installment_features(
    installments: DataFrame, as_of: int = 0, beside: Sequence[Column] = ()
) -> DataFrame:
    """15 features per customer in one aggregation over the base.

    ``beside`` are further aggregates over all rows of the raw table, taken in the same
    pass. Customers with rows outside the base only are listed then, without features.
    """
    past, columns = _base_columns(as_of)
    if beside:
        # Rows outside the base stay for the other aggregates; their base columns are null.
        base = installments.withColumns(
            {f"_{c}": F.when(past, value) for c, value in zip(BASE_COLUMNS, columns, strict=True)}
        )
        features = _aggregated(base, past, "_", beside)
        known = F.col("ins_total_obs") > 0
        names = ["ins_total_obs", "ins_late_momentum"]  # all others are null without rows
        return features.withColumns({c: F.when(known, F.col(c)) for c in names})
    return _aggregated(installment_base(installments, as_of), F.lit(True), "", ())


BASE_COLUMNS = ["DAYS_INSTALMENT", "days_late", "underpay_ratio", "is_missed"]


def _aggregated(base: DataFrame, inside: Column, prefix: str, beside: Sequence[Column]) -> DataFrame:
    """The features; ``inside`` are the rows of the base, whose columns have the prefix."""
    day, late, short, missed = (F.col(f"{prefix}{c}") for c in BASE_COLUMNS)
    in_3m, in_6m = day >= LAST_3_MONTHS, day >= LAST_6_MONTHS

    def rows(window: F.Column) -> F.Column:
        return F.nullif(F.count(F.when(window, 1)), F.lit(0))

    per_customer = base.groupBy("SK_ID_CURR").agg(
        F.avg(late).alias("ins_days_late_mean"),
        F.max(late).alias("ins_days_late_max"),
        F.avg(short).alias("ins_underpay_ratio_mean"),
        F.avg(missed).alias("ins_pct_missed"),
        F.avg(F.when(inside, F.when(late > 0, 1.0).otherwise(0.0))).alias("ins_pct_late"),
        F.count(F.when(inside, 1)).alias("ins_total_obs"),
        F.regr_slope(late, day).alias("ins_late_trend"),
        F.avg(F.when(in_3m, late)).alias("ins_days_late_l3m"),
        F.avg(F.when(in_3m, short)).alias("ins_underpay_ratio_l3m"),
        F.sum(F.when(in_3m, missed)).alias("ins_missed_count_l3m"),
        rows(in_3m).alias("ins_obs_l3m"),
        F.avg(F.when(in_6m, late)).alias("ins_days_late_l6m"),
        F.avg(F.when(in_6m, short)).alias("ins_underpay_ratio_l6m"),
        rows(in_6m).alias("ins_obs_l6m"),
        *beside,
    )
    momentum = F.coalesce("ins_days_late_l3m", F.lit(0.0)) - F.coalesce("ins_days_late_l6m", F.lit(0.0))
    return per_customer.withColumn("ins_late_momentum", momentum)
