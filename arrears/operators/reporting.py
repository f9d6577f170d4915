"""Tables behind the management report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions.columns import clip, share
from arrears.functions.ordering import number_in_order
from arrears.operators.policy import (
    CAPACITY,
    EFFECTIVENESS,
    EXPECTED_LOSS,
    first_calls,
)


def total_expected_loss(customers: DataFrame) -> DataFrame:
    return customers.agg(F.sum(F.col("PD") * F.col("EAD") * F.col("LGD")).alias("total_el"))


def top_n_bar(df: DataFrame, column: str, n: int) -> DataFrame:
    """The lowest value among the ``n`` highest; one row."""
    values = df.select(column).where(F.col(column).isNotNull())
    counted = values.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    placed = number_in_order(counted, [F.desc(column)], totals={"upto": "n"})
    return placed.where(F.col("upto") - F.col("n") < n).agg(F.min(column))


def recovery_at_capacity(
    customers: DataFrame, capacity: int = CAPACITY, effectiveness: float = EFFECTIVENESS
) -> DataFrame:
    """Simulated recovery from the highest losses; ties at the bar all count."""
    bar = top_n_bar(customers, "expected_loss", capacity).scalar()
    return customers.where(F.col("expected_loss") >= bar).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("expected_loss") * effectiveness).alias("simulated_recovery"),
    )


def capture_at_capacity(customers: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Share of defaults among the highest PDs; ties at the bar all count."""
    bar = top_n_bar(customers, "PD", capacity)
    judged = customers.withColumn("bar", bar.scalar())
    caught = F.sum(F.when(F.col("PD") >= F.col("bar"), F.col("TARGET")))
    return judged.agg((share(caught, F.sum("TARGET")) * 100).alias("capture_rate_pct"))


def tier_summary(customers: DataFrame) -> DataFrame:
    """Customers and expected loss per risk tier."""
    return customers.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("expected_loss").alias("total_el")
    )


def pd_by_tier(customers: DataFrame, bins: int = 20) -> DataFrame:
    """Customers per risk tier and equal-width PD bin."""
    index = clip(F.floor(F.col("PD") * bins), F.lit(0), F.lit(bins - 1)).cast("int")
    return customers.groupBy("risk_tier", index.alias("pd_bin")).agg(
        F.count(F.lit(1)).alias("customers")
    )


def call_list(customers: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` customers to call."""
    top = customers.orderBy("priority_rank").limit(n)
    return top.select("priority_rank", "SK_ID_CURR", "PD", "EAD", "expected_loss", "ew_flag", "risk_tier")


def top_of_list(priorities: DataFrame, n: int = 1000) -> DataFrame:
    return priorities.orderBy("priority_rank").limit(n)


def portfolio_kpis(
    customers: DataFrame,
    capacity: int = CAPACITY,
    effectiveness: float = EFFECTIVENESS,
    segment: str = "NAME_CONTRACT_TYPE",
) -> DataFrame:
    """Exposure, loss, recovery and use of capacity per segment and in total.

    The called customers enter once more as extra rows, so one rollup counts both.
    """
    rows = customers.select("SK_ID_CURR", segment, "EAD", "expected_loss")
    called = first_calls(rows, EXPECTED_LOSS, capacity)
    both = rows.withColumn("called", F.lit(False)).unionByName(called.withColumn("called", F.lit(True)))
    held, reached = ~F.col("called"), F.col("called")
    totals = both.rollup(segment).agg(
        F.grouping(segment).alias("is_total"),
        F.count(F.when(held, 1)).alias("customers"),
        F.sum(F.when(held, F.col("EAD"))).alias("exposure_at_risk"),
        F.sum(F.when(held, F.col("expected_loss"))).alias("total_el"),
        F.count(F.when(reached, 1)).alias("customers_called"),
        F.coalesce(F.sum(F.when(reached, F.col("expected_loss") * effectiveness)), F.lit(0.0)).alias("recovery"),
    )
    return totals.select(
        F.when(F.col("is_total") == 1, "All").otherwise(F.col(segment)).alias("segment"),
        "customers",
        "exposure_at_risk",
        "total_el",
        "customers_called",
        "recovery",
        (share(F.col("recovery"), F.col("total_el")) * 100).alias("recovery_rate_pct"),
        (share(F.col("customers_called"), F.lit(capacity)) * 100).alias("capacity_use_pct"),
    )


def customer_dimension(store: DataFrame, priorities: DataFrame, flags: DataFrame) -> DataFrame:
    """Store columns with priority and warning flag per customer."""
    ranked = priorities.drop("TARGET")
    flagged = flags.drop("TARGET")
    return store.join(ranked, "SK_ID_CURR", "left").join(flagged, "SK_ID_CURR", "left")
