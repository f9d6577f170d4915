"""Credit card features: utilization, repayment and arrears by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_3_MONTHS = -3


def _base_columns(as_of: int) -> tuple[Column, list[Column]]:
    """Which rows belong to the base, and its columns."""

    def ratio(amount: str, reference: str) -> Column:
        return F.when(F.col(reference) > 0, F.try_divide(amount, reference))

    return F.col("MONTHS_BALANCE") < -as_of, [
        (F.col("MONTHS_BALANCE") + as_of).alias("MONTHS_BALANCE"),
        F.col("AMT_BALANCE"),
        F.col("AMT_DRAWINGS_CURRENT"),
        F.col("SK_DPD"),
        ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL").alias("utilization"),
        ratio("AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY").alias("min_pay_ratio"),
    ]


BASE_COLUMNS = [
    "MONTHS_BALANCE",
    "AMT_BALANCE",
    "AMT_DRAWINGS_CURRENT",
    "SK_DPD",
    "utilization",
    "min_pay_ratio",
]


def card_base(card_balance: DataFrame, as_of: int = 0) -> DataFrame:
    """Strictly past months with utilization and minimum-payment ratio."""
    past, columns = _base_columns(as_of)
    return card_balance.where(past).select("SK_ID_CURR", *columns)


def card_features(card_balance: DataFrame, as_of: int = 0, beside: Sequence[Column] = ()) -> DataFrame:
    """15 features per customer in one aggregation over the base.

    ``beside`` are further aggregates over all rows of the raw table, taken in the same
    pass. Customers with rows outside the base only are listed then, without features.
    """
    past, columns = _base_columns(as_of)
    if beside:
        base = card_balance.withColumns(
            {f"_{c}": F.when(past, value) for c, value in zip(BASE_COLUMNS, columns, strict=True)}
        )
        features = _aggregated(base, past, "_", beside)
        known = F.col("cc_total_obs") > 0
        # All other features are null without rows.
        return features.withColumn("cc_total_obs", F.when(known, F.col("cc_total_obs")))
    return _aggregated(card_base(card_balance, as_of), F.lit(True), "", ())


def _aggregated(base: DataFrame, inside: Column, prefix: str, beside: Sequence[Column]) -> DataFrame:
    """The features; ``inside`` are the rows of the base, whose columns have the prefix."""
    month, balance, drawings, dpd, used, paid = (F.col(f"{prefix}{c}") for c in BASE_COLUMNS)
    in_3m = month >= LAST_3_MONTHS

    def recent(column: Column) -> Column:
        return F.avg(F.when(in_3m, column))

    return base.groupBy("SK_ID_CURR").agg(
        F.avg(used).alias("cc_util_mean"),
        F.max(used).alias("cc_util_max"),
        F.avg(balance).alias("cc_balance_mean"),
        F.max(dpd).alias("cc_dpd_max"),
        F.avg(dpd).alias("cc_dpd_mean"),
        F.avg(paid).alias("cc_min_pay_ratio_mean"),
        F.regr_slope(used, month).alias("cc_util_trend"),
        F.regr_slope(balance, month).alias("cc_balance_trend"),
        F.regr_slope(drawings, month).alias("cc_drawings_trend"),
        F.count(F.when(inside, 1)).alias("cc_total_obs"),
        recent(used).alias("cc_util_l3m"),
        recent(balance).alias("cc_balance_l3m"),
        recent(dpd).alias("cc_dpd_l3m"),
        recent(paid).alias("cc_min_pay_ratio_l3m"),
        F.nullif(F.count(F.when(in_3m, 1)), F.lit(0)).alias("cc_obs_l3m"),
        *beside,
    )
