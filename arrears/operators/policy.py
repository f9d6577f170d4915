"""Whom to call first: expected loss, calling strategies and their outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.functions.columns import hash_order, share
from arrears.functions.counting import counted_quantiles
from arrears.functions.ordering import first_in_order, number_in_order
from arrears.operators.split import SEED
from arrears.sources.staging import stage

# Policy assumptions.
CAPACITY = 200
LGD = 0.45
EFFECTIVENESS = 0.30
COST_PER_CALL = 150
HOURS_PER_CALL = 0.25
CURVE_STEP = 100
CURVE_END = 5000
SAMPLE_SIZE = 5000

HASH_DIGITS = 12  # 48 bits, which a double holds

RANDOM = "1. Call Everyone (Random)"
HIGHEST_PD = "2. Highest PD First"
EXPECTED_LOSS = "3. Expected Loss Policy"



def strategies(seed: int = SEED, key: str = "SK_ID_CURR") -> dict[str, tuple[Column, Column]]:
    """A text and a number by which each strategy calls the customers, both ascending.

    Customers with equal ones are called by their key. The number of a text never falls
    along the text: it is that of its first hexadecimal digits.
    """
    text = hash_order(key, seed)
    return {
        RANDOM: (text, F.conv(F.substring(text, 1, HASH_DIGITS), 16, 10).cast("double")),
        HIGHEST_PD: (F.lit(""), -F.col("PD")),
        EXPECTED_LOSS: (F.lit(""), -F.col("expected_loss")),
    }


def _order(text: Column, number: Column, key: str) -> list[Column]:
    return [text, number.asc_nulls_last(), F.col(key)]


def _first(
    df: DataFrame, names: Sequence[str], calls: int, totals: Sequence[str], seed: int, key: str
) -> DataFrame:
    """The first calls of some strategies with their positions."""
    chosen = {name: strategies(seed, key)[name] for name in names}
    # Equal numbers leave the key to decide, but where a text stands before it.
    levels = {name: [number] if name == RANDOM else [number, F.col(key)] for name, (_, number) in chosen.items()}
    orders = {name: ([text, number, F.col(key)], levels[name]) for name, (text, number) in chosen.items()}
    return first_in_order(df, orders, calls, "strategy", {f"running_{c}": c for c in totals})


def priority_frame(
    scored: DataFrame,
    lgd: float = LGD,
    effectiveness: float = EFFECTIVENESS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Exposure, expected loss and recovery per customer from ``PD``.

    PD is rounded before it enters the loss; a missing loan amount becomes the median.
    The scores are staged, because every report below reads this table several times.
    """
    narrow = stage(scored.select("SK_ID_CURR", "TARGET", "PD", "app_loan_amount", *keep))
    typical = F.lit(counted_quantiles(narrow, ["app_loan_amount"], [0.5]).first().q0)
    exposed = narrow.select(
        "SK_ID_CURR",
        "TARGET",
        F.round("PD", 4).alias("PD"),
        F.coalesce("app_loan_amount", typical).alias("EAD"),
        F.lit(lgd).alias("LGD"),
        *keep,
    )
    loss = F.col("PD") * F.col("EAD") * F.col("LGD")
    return exposed.withColumn("expected_loss", loss).withColumns(
        {
            "contact_eff": F.lit(effectiveness),
            "recovery_if_called": F.col("expected_loss") * effectiveness,
        }
    )


def attach_flags(priority: DataFrame, flags: DataFrame) -> DataFrame:
    return priority.join(flags.select("SK_ID_CURR", "ew_flag", "risk_tier"), "SK_ID_CURR", "left")


def first_calls(
    df: DataFrame, strategy: str, calls: int | None, seed: int = SEED, key: str = "SK_ID_CURR"
) -> DataFrame:
    """The first ``calls`` customers of a strategy, or all if there are fewer."""
    if calls is None:
        return df
    return _first(df, [strategy], calls, [], seed, key).select(*df.columns)


def call_positions(
    df: DataFrame,
    totals: Sequence[str] = (),
    seed: int = SEED,
    key: str = "SK_ID_CURR",
    calls: int | None = None,
) -> DataFrame:
    """Every customer's ``position`` in every strategy, and ``running_`` sums up to it.

    All strategies are put in order together, as groups of one range shuffle; with ``calls``
    only the first so many customers of each.
    """
    if calls is not None:
        narrow = df.select(key, "PD", "expected_loss", *[c for c in totals if c != "expected_loss"])
        placed = _first(narrow, list(strategies()), calls, totals, seed, key)
        running = [f"running_{c}" for c in totals]
        return placed.select(key, *totals, "strategy", "position", *running)
    listed_calls = F.array(
        *[
            F.struct(F.lit(name).alias("strategy"), text.alias("_text"), number.alias("_number"))
            for name, (text, number) in strategies(seed, key).items()
        ]
    )
    listed = df.select(key, *totals, F.inline(listed_calls))
    running = {f"running_{c}": c for c in totals}
    order = _order(F.col("_text"), F.col("_number"), key)
    placed = number_in_order(listed, order, totals=running, by=["strategy"])
    return placed.drop("_text", "_number")


def evaluate_strategies(
    priority: DataFrame,
    capacity: int = CAPACITY,
    cost: float = COST_PER_CALL,
    effectiveness: float = EFFECTIVENESS,
) -> DataFrame:
    """Loss reached, recovery, cost and profit of each strategy at ``capacity`` calls."""
    narrow = priority.select("SK_ID_CURR", "PD", "expected_loss")
    called = call_positions(narrow, ["expected_loss"], calls=capacity)
    portfolio = narrow.agg(F.sum("expected_loss")).scalar()
    reached = called.groupBy("strategy").agg(
        F.count(F.lit(1)).alias("customers_called"), F.sum("expected_loss").alias("el")
    )
    recovery = F.col("el") * effectiveness
    call_cost = F.col("customers_called") * F.lit(cost)
    hours = F.greatest(F.col("customers_called") * F.lit(HOURS_PER_CALL), F.lit(1.0))
    return (
        reached.withColumn("portfolio", portfolio)
        .select(
            "strategy",
            "customers_called",
            F.round("portfolio", 2).alias("total_EL_portfolio"),
            F.round("el", 2).alias("EL_called"),
            F.round(recovery, 2).alias("recovery_simulated"),
            call_cost.alias("call_cost"),
            F.round(recovery - call_cost, 2).alias("net_profit"),
            F.round(recovery / hours, 2).alias("recovery_per_hour"),
            F.round(share(F.col("el"), F.col("portfolio")) * 100, 1).alias("pct_EL_covered"),
        )
        .orderBy("strategy")
    )


def recovery_curve(
    priority: DataFrame,
    step: int = CURVE_STEP,
    end: int | None = CURVE_END,
    effectiveness: float = EFFECTIVENESS,
) -> DataFrame:
    """Recovery after every ``step`` calls, below ``end`` (None: no end) and the portfolio size."""
    narrow = priority.select("SK_ID_CURR", "PD", "expected_loss")
    size = narrow.agg(F.count(F.lit(1))).scalar()
    placed = call_positions(narrow, ["expected_loss"], calls=end)
    last = size if end is None else F.least(F.lit(end), size)
    return placed.where((F.col("position") % step == 0) & (F.col("position") < last)).select(
        "strategy",
        F.col("position").alias("calls"),
        (F.col("running_expected_loss") * effectiveness).alias("recovery"),
    )


def priority_list(priority: DataFrame, effectiveness: float = EFFECTIVENESS) -> DataFrame:
    """All customers ranked 1..N by expected loss."""
    columns = ["SK_ID_CURR", "PD", "EAD", "LGD", "expected_loss", "recovery_if_called", "TARGET"]
    order = _order(*strategies()[EXPECTED_LOSS], "SK_ID_CURR")
    placed = number_in_order(priority.select(*columns), order)
    return placed.select(
        *columns,
        F.col("position").alias("priority_rank"),
        F.lit(effectiveness).alias("contact_eff_assumption"),
    )


def policy_gain(metrics: DataFrame) -> DataFrame:
    """What the expected-loss policy earns beyond random calling."""

    def of(strategy: str, column: str) -> Column:
        return F.max(F.when(F.col("strategy") == strategy, F.col(column)))

    gained = metrics.agg(
        *[
            (of(EXPECTED_LOSS, c) - of(RANDOM, c)).alias(f"{c}_gain")
            for c in ("net_profit", "recovery_simulated", "recovery_per_hour")
        ],
        of(RANDOM, "recovery_simulated").alias("_base"),
    )
    return gained.select(
        F.round("net_profit_gain", 2).alias("net_profit_gain"),
        F.round("recovery_simulated_gain", 2).alias("recovery_gain"),
        F.round("recovery_per_hour_gain", 2).alias("recovery_per_hour_gain"),
        F.round(share(F.col("recovery_simulated_gain"), F.col("_base")) * 100, 1).alias("recovery_gain_pct"),
    )


def loss_sample(priority: DataFrame, size: int | None = SAMPLE_SIZE, seed: int = SEED) -> DataFrame:
    """A seeded random sample of customers for the PD against EAD view; None takes all."""
    columns = ["SK_ID_CURR", "PD", "EAD", "expected_loss"]
    return first_calls(priority.select(*columns), RANDOM, size, seed)
