"""Positions, running totals and exact quantiles over whole tables of any size.

A window without partition columns sorts the whole table in one task. Here the table is cut
into slices by range over the complete sort key, so a slice holds about the same number of
rows however often one sort value repeats. Each task numbers and sums its sorted slice as it
streams by, and the result is shifted by what the earlier slices hold; that shift table has
one row per slice and group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.functions.counting import values_at
from arrears.sources.staging import stage

SKETCH_ACCURACY = 10_000  # the sketch misses a rank by at most 1 / accuracy of the rows
ONE_TASK = 50_000  # rows that one task may number
BRACKETS = (5 / SKETCH_ACCURACY, 500 / SKETCH_ACCURACY, 1.0)  # half widths; the last holds all


def with_group_values(df: DataFrame, by: Sequence[str], values: DataFrame) -> DataFrame:
    """Append the columns of ``values``, one row per group.

    The values are staged, so the optimizer knows their size and broadcasts them only when
    they are small; for many groups it joins by key.
    """
    if by:
        return df.join(stage(values), list(by))
    packed = values.select(F.struct(*values.columns)).scalar()
    return df.withColumn("_whole", packed).select(
        *df.columns, *[F.col("_whole")[c].alias(c) for c in values.columns]
    )


def with_group_totals(df: DataFrame, by: Sequence[str], totals: Sequence[Column]) -> DataFrame:
    """Append whole-group aggregates of ``df`` to every row. ``df`` is read twice."""
    return with_group_values(df, by, df.groupBy(*by).agg(*totals))


def number_in_order(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Append ``position`` (1-based) and running totals in the given total order.

    ``order`` must decide between any two rows, so end it with a unique key. ``totals``
    maps new column to the summed column; a total includes its own row and passes over
    nulls and stays exact for whole numbers and decimals. ``by`` numbers each group on its
    own; a null is a group of its own.

    One range shuffle and one write: the shuffle takes as many slices as the size asks
    for, and the numbered slices are staged, which also makes their last rows cheap to
    read for the shift.
    """
    totals, by = dict(totals or {}), list(by)
    decimals = {t: df.schema[c].dataType for t, c in totals.items() if isinstance(df.schema[c].dataType, T.DecimalType)}
    if decimals:
        return _with_decimal_totals(df, order, totals, by, decimals)
    names = list(df.columns)
    at = [names.index(c) for c in by]
    exact = {
        name: not isinstance(df.schema[source].dataType, (T.DoubleType, T.FloatType))
        for name, source in totals.items()
    }
    added = [
        T.StructField("_slice", T.IntegerType()),
        T.StructField("position", T.LongType()),
        *[T.StructField(n, T.LongType() if exact[n] else T.DoubleType()) for n in totals],
    ]

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_rows, held_sums = None, 0, dict.fromkeys(totals, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(i) for i in range(len(names) + 1)]
            new = _changes([columns[i] for i in at], n)
            if held_key is not None:
                new[0] = held_key != [columns[i][0].as_py() for i in at]
            starts = np.flatnonzero(np.append(True, new[1:]))
            group = np.cumsum(np.append(False, new[1:]))
            position = np.arange(n) - starts[group] + 1
            goes_on = group == 0 if held_key is not None and not new[0] else np.zeros(n, dtype=bool)
            position = position + goes_on * held_rows
            sums = []
            for name, source in totals.items():
                kind = np.int64 if exact[name] else np.float64
                value = columns[names.index(source)].fill_null(0).to_numpy(zero_copy_only=False).astype(kind)
                # Sums of each group on their own: no rounding comes from other groups.
                own = np.concatenate([np.cumsum(v) for v in np.split(value, starts[1:])])
                own = own + goes_on * kind(held_sums[name])
                sums.append(pa.array(own))
                held_sums[name] = own[-1]
            held_key, held_rows = [columns[i][n - 1].as_py() for i in at], int(position[-1])
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(position), *sums], names=[*names, "_slice", "position", *totals]
            )

    groups = [F.col(c) for c in by]
    sliced = df.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
    marked = sliced.withColumn("_slice", F.spark_partition_id())
    numbered = stage(marked.mapInArrow(number, T.StructType([*df.schema.fields, *added])))

    last = {name: f"_last_{name}" for name in totals}
    sizes = numbered.groupBy(*by, "_slice").agg(
        F.max("position").alias("_rows"),
        *[F.max_by(name, "position").alias(column) for name, column in last.items()],
    )
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    held = {"position": "_rows", **last}
    shifts = stage(
        sizes.select(
            *[F.col(c).alias(f"_by_{c}") for c in by],
            F.col("_slice").alias("_of_slice"),
            *[F.sum(source).over(earlier).alias(f"_before_{name}") for name, source in held.items()],
        ).where(F.col("_before_position").isNotNull())
    )
    # Only groups that go on from an earlier slice: fewer than there are slices.
    same = [F.col("_slice") == F.col("_of_slice"), *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]]
    return numbered.join(shifts, reduce(and_, same), "left").select(
        *names,
        *[(F.col(name) + F.coalesce(f"_before_{name}", F.lit(0))).alias(name) for name in held],
    )


def _with_decimal_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, str],
    by: Sequence[str],
    decimals: Mapping[str, T.DecimalType],
) -> DataFrame:
    """``number_in_order`` with decimals summed as whole numbers of their last digit."""
    units = {f"_units_{t}": (t, 10**kind.scale) for t, kind in decimals.items()}
    scaled = df.withColumns(
        {c: (F.col(totals[t]) * F.lit(unit)).cast("bigint") for c, (t, unit) in units.items()}
    )
    sources = dict(totals) | {t: c for c, (t, _) in units.items()}
    placed = number_in_order(scaled, order, sources, by).drop(*units)
    return placed.withColumns(
        {
            t: (F.col(t).cast("decimal(19,0)") / F.lit(unit)).cast(T.DecimalType(38, decimals[t].scale))
            for t, unit in units.values()
        }
    )


def first_in_order(
    df: DataFrame,
    orders: Mapping[str, tuple[Sequence[Column], Sequence[Column]]],
    n: int,
    name: str,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """The first ``n`` rows of each order with ``position`` and running totals, or all if fewer.

    An order is its sort columns, ascending with nulls last and deciding between any two
    rows, and its levels: numbers that never fall along the sort, the second among rows that
    agree in the first, and so on; nulls and NaN stand last. All orders have as many sort
    columns of the same types. ``name`` becomes the column with the order.

    The value of the n-th row is found by counting, level by level and for all orders in the
    same passes. Only the rows up to it are put in order: n, and those that agree with the
    last of them in all levels. The counts also tell how many rows that is; up to
    ``ONE_TASK`` of an order are numbered by one task. ``df`` is read a few times, so stage
    it if it is costly.
    """
    inside, most = _first_rows(df, {o: levels for o, (_, levels) in orders.items()}, n)
    width = len(next(iter(orders.values()))[0])
    sorts = [f"_sort{i}" for i in range(width)]
    listed = F.array(
        *[
            F.struct(
                F.lit(o).alias(name),
                inside[o].alias("_inside"),
                *[value.alias(c) for c, value in zip(sorts, sort, strict=True)],
            )
            for o, (sort, _) in orders.items()
        ]
    )
    kept = df.where(reduce(or_, inside.values()))
    rows = kept.select(*df.columns, F.inline(listed)).where("_inside").drop("_inside")
    order = [F.asc_nulls_last(c) for c in sorts]
    if most > ONE_TASK:
        placed = number_in_order(rows, order, totals, by=[name])
    else:
        counted = Window.partitionBy(name).orderBy(*order)
        upto = counted.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = {c: F.coalesce(F.sum(source).over(upto), F.lit(0)) for c, source in (totals or {}).items()}
        placed = rows.withColumns({"position": F.row_number().over(counted).cast("bigint"), **sums})
    return placed.where(F.col("position") <= n).drop(*sorts)


def _first_rows(
    df: DataFrame, orders: Mapping[str, Sequence[Column]], n: int
) -> tuple[dict[str, Column], int]:
    """For each order, given by its levels, a condition that holds for its first ``n`` rows.

    Also the largest number of rows for which one of the conditions holds.
    """
    last = F.lit(float("inf"))
    before: dict[str, Column] = dict.fromkeys(orders, F.lit(False))
    equal: dict[str, Column] = dict.fromkeys(orders, F.lit(True))
    needed, held = dict.fromkeys(orders, n), dict.fromkeys(orders, 0)
    open_orders = list(orders)
    for level in range(max(map(len, orders.values()))):
        open_orders = [o for o in open_orders if level < len(orders[o])]
        if not open_orders:
            break
        values = {o: F.coalesce(F.nanvl(orders[o][level].cast("double"), last), last) for o in open_orders}
        columns = {f"_value{i}": o for i, o in enumerate(open_orders)}
        numbers = df.select(*[F.when(equal[o], values[o]).alias(c) for c, o in columns.items()])
        found = values_at(
            numbers, list(columns), lambda c, total, at=columns: [min(needed[at[c]], total) - 1]
        )
        for (_, column), (_, places) in found.items():
            o = columns[column]
            for place in places.values():
                before[o] = before[o] | (equal[o] & (values[o] < place.value))
                equal[o] = equal[o] & (values[o] == place.value)
                if place.upto <= needed[o]:
                    open_orders.remove(o)  # all that agree with the last row are needed
                held[o] = n - needed[o] + place.upto
                needed[o] -= place.below
    return {o: before[o] | equal[o] for o in orders}, max(held.values())


def _changes(keys: Sequence[pa.Array], n: int) -> np.ndarray:
    """Where a row's keys differ from those of the row before; true at the first."""
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for key in keys:
        codes = key.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def exact_quantiles(
    df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles ``q0, q1, ...`` of the non-null values, per group.

    A quantile sketch first brackets each quantile; only the values inside the brackets
    are sorted, the others are counted. The counts tell whether a bracket holds its
    quantile. Should one miss, all are widened; the widest holds all values. Equal values
    collapse to one row before sorting. Without values the quantiles are null. ``df`` is
    read several times, so stage it if it is costly.
    """
    by = list(by)
    present = df.select(*by, value).where(F.col(value).isNotNull())
    found = present
    for bracket in BRACKETS:
        found = stage(_bracketed_quantiles(present, value, shares, by, bracket))
        missed = reduce(or_, [F.col(f"q{i}").isNull() for i in range(len(shares))], F.lit(False))
        if found.where(missed & (F.col("_total") > 0)).isEmpty():
            break
    return found.drop("_total")


def _bracketed_quantiles(
    present: DataFrame, value: str, shares: Sequence[float], by: Sequence[str], bracket: float
) -> DataFrame:
    """Quantiles from the values near them; null where a bracket misses its quantile."""
    near = [(max(p - bracket, 0.0), min(p + bracket, 1.0)) for p in shares]
    sketch = F.percentile_approx(value, [p for pair in near for p in pair], SKETCH_ACCURACY)
    guessed = present.groupBy(*by).agg(sketch.alias("_limits"))
    bracketed = with_group_values(present, by, guessed)
    v = F.col(value)

    def inside(i: int) -> Column:
        return (v >= F.col("_limits")[2 * i]) & (v <= F.col("_limits")[2 * i + 1])

    kept = reduce(or_, [inside(i) for i in range(len(shares))])
    below = [~kept & (v < F.col("_limits")[2 * i]) for i in range(len(shares))]
    tally = bracketed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_total"),
        F.first("_limits").alias("_limits"),
        *[F.count(F.when(b, 1)).alias(f"_below{i}") for i, b in enumerate(below)],
    )
    counted = bracketed.where(kept).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_count"))
    placed = number_in_order(counted, [v], totals={"_upto": "_count"}, by=by)
    sized = with_group_values(placed, by, tally)
    parts, quantiles = [F.max("_total").alias("_total")], []
    for i, p in enumerate(shares):
        spot = F.lit(float(p)) * (F.col("_total") - 1)
        upto = F.col("_upto") + F.col(f"_below{i}")

        def at(rank: Column, i: int = i, upto: Column = upto) -> Column:
            held = inside(i) & (rank >= upto - F.col("_count")) & (rank < upto)
            return F.max(F.when(held, v))

        parts += [
            at(F.floor(spot)).alias(f"_low{i}"),
            at(F.ceil(spot)).alias(f"_high{i}"),
            F.max(spot - F.floor(spot)).alias(f"_part{i}"),
        ]
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        quantiles.append((low + (high - low) * F.col(f"_part{i}")).alias(f"q{i}"))
    return sized.groupBy(*by).agg(*parts).select(*by, "_total", *quantiles)
