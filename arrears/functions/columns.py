"""Column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(numerator: Column, denominator: Column) -> Column:
    """Ratio as a double; null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def clip(value: Column, low: Column | None = None, high: Column | None = None) -> Column:
    """``value`` kept inside the bounds; null stays null."""
    bounded = value
    if low is not None:
        bounded = F.when(value.isNotNull(), F.greatest(bounded, low))
    if high is not None:
        bounded = F.when(value.isNotNull(), F.least(bounded, high))
    return bounded


def hash_order(key: str, seed: int) -> Column:
    """A seeded pseudo-random string per key, the same in any engine that has MD5."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def stack_columns(columns: Sequence[str], name: str, value: str) -> Column:
    """Generator with one (``name``, ``value``) row per column, values as doubles."""
    return F.inline(
        F.array(
            *[
                F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value))
                for c in columns
            ]
        )
    )
