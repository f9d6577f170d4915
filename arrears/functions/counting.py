"""Exact values at given ranks by counting, for many columns at once.

Doubles map to 64-bit numbers in the same order. Each round cuts the interval that holds a
wanted rank into equal cells and counts the values in them, and the cell with the rank is
the next interval. Once an interval has few values, its distinct ones are counted instead,
which ends it. Tasks pass on one row per column, group and cell; neither rows nor values
are shuffled or unpivoted, and the number of rounds depends on 64 bits, not on the rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

CELL_BITS = 11
CELLS = 2**CELL_BITS
FEW = 2048  # values of an interval that are told apart by themselves
TOP = np.uint64(1 << 63)

Group = tuple


@dataclass(frozen=True)
class Place:
    """A value, how many values are smaller, and how many are not larger."""

    value: float
    below: int
    upto: int


@dataclass(frozen=True)
class _Interval:
    """Numbers from ``low`` to ``high`` that hold some wanted ranks."""

    low: int
    high: int
    width: int  # of a cell; 0: the values themselves are counted
    before: int  # values below the interval
    ranks: list[int]


WHOLE = (0, 2**64 - 1, 2**64 // CELLS)


def _numbers(values: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers in the same order; NaN is the largest, both zeros are one."""
    values = np.where(np.isnan(values), np.nan, values) + 0.0
    bits = values.view(np.uint64)
    return np.where(bits & TOP != 0, ~bits, bits | TOP)


def _double(number: int) -> float:
    bits = np.uint64(number)
    bits = bits & ~TOP if bits & TOP else ~bits
    return float(bits.view(np.float64))


def _counts(df: DataFrame, columns: Sequence[str], by: Sequence[str], plan: dict | None) -> list:
    """Rows (group..., column, part, cell, n) of the values in the intervals of the plan.

    Without a plan all groups are counted over all numbers.
    """
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[tuple, np.ndarray] = {}
        values: dict[tuple, Counter] = {}
        for batch in batches:
            for group, rows in _groups(batch, len(by)):
                for at, column in enumerate(columns):
                    parts = [WHOLE] if plan is None else plan.get((group, column))
                    found = rows.column(len(by) + at).drop_null() if parts else ()
                    if not len(found):
                        continue
                    numbers = _numbers(found.to_numpy(zero_copy_only=False))
                    for part, (low, high, width) in enumerate(parts):
                        inside = numbers[(numbers >= np.uint64(low)) & (numbers <= np.uint64(high))]
                        if width:
                            cell = ((inside - np.uint64(low)) // np.uint64(width)).astype(np.int64)
                            held = cells.setdefault((group, column, part), np.zeros(CELLS, dtype=np.int64))
                            held += np.bincount(cell, minlength=CELLS)
                        else:
                            listed, n = np.unique(inside, return_counts=True)
                            here = values.setdefault((group, column, part), Counter())
                            here.update(dict(zip(listed.tolist(), n.tolist(), strict=True)))
        for key, held in cells.items():
            yield _rows(key, np.flatnonzero(held).tolist(), held[held > 0].tolist())
        for key, here in values.items():
            yield _rows(key, list(here), list(here.values()))

    def _rows(key: tuple, cell: list[int], n: list[int]) -> pa.RecordBatch:
        group, column, part = key
        held = {c: pa.array([g] * len(cell), kind) for c, g, kind in zip(by, group, kinds, strict=True)}
        held["_column"] = pa.array([column] * len(cell), pa.string())
        held["_part"] = pa.array([part] * len(cell), pa.int32())
        held["_cell"] = pa.array(np.array(cell, dtype=np.uint64).view(np.int64))
        held["_n"] = pa.array(n, pa.int64())
        return pa.RecordBatch.from_pydict(held)

    fields = [df.schema[c] for c in by]
    kinds = [to_arrow_type(f.dataType) for f in fields]
    added = [("_column", T.StringType()), ("_part", T.IntegerType()), ("_cell", T.LongType()), ("_n", T.LongType())]
    schema = T.StructType([*fields, *[T.StructField(c, t) for c, t in added]])
    narrow = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    partial = narrow.mapInArrow(count, schema)
    return partial.groupBy(*by, "_column", "_part", "_cell").agg(F.sum("_n").alias("n")).collect()


def _groups(batch: pa.RecordBatch, size: int) -> Iterator[tuple[Group, pa.RecordBatch]]:
    """The rows of each group; a null is a group of its own."""
    if not size:
        yield (), batch
        return
    columns = [batch.column(i).dictionary_encode() for i in range(size)]
    codes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in columns:
        own = column.indices.fill_null(len(column.dictionary)).to_numpy(zero_copy_only=False)
        codes = codes * (len(column.dictionary) + 1) + own
    for code in np.unique(codes).tolist():
        same = codes == code
        first = int(np.argmax(same))
        yield tuple(batch.column(i)[first].as_py() for i in range(size)), batch.filter(pa.array(same))


def values_at(
    df: DataFrame, columns: Sequence[str], ranks: Callable[[str, int], Sequence[int]], by: Sequence[str] = ()
) -> dict[tuple[Group, str], tuple[int, dict[int, Place]]]:
    """Per group and column the number of values and what stands at the wanted ranks.

    ``ranks`` gives the ranks (from 0, ascending values) wanted of a column and so many
    values. Nulls are no values; NaN is larger than all others. A group and column without values is missing.
    The driver holds one entry per column, group and cell, so groups have to be few, such as
    classes or samples. ``df`` is read once a round, so stage it if it is costly.
    """
    by, size = list(by), len(by)

    def by_part(plan: dict | None) -> dict[tuple, list[dict[int, int]]]:
        found: dict[tuple, dict[int, dict[int, int]]] = {}
        for r in _counts(df, columns, by, plan):
            held = found.setdefault((tuple(r[:size]), r["_column"]), {}).setdefault(r["_part"], {})
            held[r["_cell"] % 2**64] = r["n"]
        return found

    state: dict[tuple, tuple[int, dict[int, Place]]] = {}
    open_parts: dict[tuple, list[_Interval]] = {}
    counted = by_part(None)
    for key, parts in counted.items():
        total = sum(parts[0].values())
        state[key] = (total, {})
        wanted = sorted({r for r in ranks(key[1], total) if 0 <= r < total})
        if wanted:
            open_parts[key] = [_Interval(*WHOLE, 0, wanted)]
    while open_parts:
        plan = {}
        for key, intervals in open_parts.items():
            narrower: list[_Interval] = []
            for part, interval in enumerate(intervals):
                narrower += _narrowed(interval, counted[key][part], state[key][1])
            if narrower:
                plan[key] = narrower
        open_parts = plan
        if plan:
            counted = by_part({key: [(i.low, i.high, i.width) for i in held] for key, held in plan.items()})
    return state


def _narrowed(interval: _Interval, cells: dict[int, int], found: dict[int, Place]) -> list[_Interval]:
    """The intervals that still hide ranks; ranks whose value is known go to ``found``."""
    out: list[_Interval] = []
    before, ranks = interval.before, list(interval.ranks)
    for cell in sorted(cells):
        n = cells[cell]
        here = [r for r in ranks if before <= r < before + n]
        if here:
            low = interval.low + cell * interval.width if interval.width else cell
            if interval.width <= 1:
                place = Place(_double(low), before, before + n)
                found.update(dict.fromkeys(here, place))
            else:
                width = 0 if n <= FEW else max(interval.width // CELLS, 1)
                out.append(_Interval(low, low + interval.width - 1, width, before, here))
        before += n
    return out


def counted_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles ``q0, q1, ...`` of each column's non-null values.

    One row per column (named in ``column``) and group that ``df`` has; null without values.
    """
    shares, by = list(shares), list(by)

    def around(column: str, total: int) -> list[int]:
        spots = [p * (total - 1) for p in shares]
        return [r for s in spots for r in (int(np.floor(s)), int(np.ceil(s)))]

    found = values_at(df, columns, around, by)
    groups = [tuple(r) for r in df.select(*by).distinct().collect()] if by else [()]
    rows = []
    for group in groups:
        for column in columns:
            total, places = found.get((group, column), (0, {}))
            quantiles = []
            for p in shares:
                spot = p * (total - 1)
                low, high = (places.get(int(f(spot))) for f in (np.floor, np.ceil))
                part = spot - np.floor(spot)
                quantiles.append(float(low.value + (high.value - low.value) * part) if low else None)
            rows.append((*group, column, *quantiles))
    fields = [df.schema[c] for c in by]
    doubles = [T.StructField(f"q{i}", T.DoubleType()) for i in range(len(shares))]
    schema = T.StructType([*fields, T.StructField("column", T.StringType()), *doubles])
    return df.sparkSession.createDataFrame(rows, schema)
