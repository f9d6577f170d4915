"""What-if scenarios over the calling strategies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.operators.policy import (
    CAPACITY,
    COST_PER_CALL,
    EFFECTIVENESS,
    HOURS_PER_CALL,
    call_positions,
)


def _outcome(el: F.Column, effectiveness: F.Column, cost: F.Column, calls: F.Column) -> dict[str, F.Column]:
    recovery = el * effectiveness
    return {
        "el_called": F.round(el, 2),
        "recovery": F.round(recovery, 2),
        "call_cost": F.round(calls * cost, 2),
        "net_profit": F.round(recovery - calls * cost, 2),
        "recovery_per_hour": F.round(recovery / F.greatest(calls * F.lit(HOURS_PER_CALL), F.lit(1.0)), 2),
    }


def linear_scenario(
    metrics: DataFrame,
    capacity: int = CAPACITY,
    cost: float = COST_PER_CALL,
    effectiveness: float = EFFECTIVENESS,
    base_capacity: int = CAPACITY,
) -> DataFrame:
    """Scale each strategy's loss per call, measured at the base capacity, to ``capacity``."""
    calls = F.lit(float(capacity))
    el = F.round(F.col("EL_called") / base_capacity, 2) * calls
    outcome = _outcome(el, F.lit(effectiveness), F.lit(float(cost)), calls)
    return metrics.select(
        "strategy",
        F.lit(capacity).alias("customers_called"),
        *[column.alias(name) for name, column in outcome.items()],
    )


def scenario_grid(
    priority: DataFrame,
    capacities: Sequence[int] = (100, 200, 500, 1000),
    costs: Sequence[float] = (100.0, 150.0, 200.0),
    efforts: Sequence[float] = (0.2, 0.3, 0.4),
    lgds: Sequence[float] = (0.35, 0.45, 0.55),
) -> DataFrame:
    """Exact outcome of every strategy under every combination of the inputs.

    One running sum per strategy answers all capacities; the loss is linear in LGD and
    its order does not depend on it, so LGD scales the sum.
    """
    exposed = priority.select(
        "SK_ID_CURR", "PD", "expected_loss", (F.col("PD") * F.col("EAD")).alias("exposure")
    )
    size = exposed.agg(F.count(F.lit(1))).scalar()
    prefixes = call_positions(exposed, ["exposure"], calls=max(capacities))

    def each(values: Sequence[float]) -> F.Column:
        return F.explode(F.array(*[F.lit(v) for v in values]))

    reached = (
        prefixes.withColumn("size", size)
        .withColumn("capacity", F.explode(F.array(*[F.lit(int(c)) for c in capacities])))
        .where(F.col("position") == F.least(F.col("capacity"), F.col("size")))
    )
    grid = (
        reached.withColumn("cost_per_call", each(costs))
        .withColumn("effectiveness", each(efforts))
        .withColumn("lgd", each(lgds))
    )
    outcome = _outcome(
        F.col("running_exposure") * F.col("lgd"),
        F.col("effectiveness"),
        F.col("cost_per_call"),
        F.col("position").cast("double"),
    )
    return grid.select(
        "strategy",
        "capacity",
        "cost_per_call",
        "effectiveness",
        "lgd",
        F.col("position").alias("customers_called"),
        *[column.alias(name) for name, column in outcome.items()],
    )

