"""Product codes of vectors: one byte per part, from codebooks of integer entries.

Components become integers, and every block of vectors holds one dictionary of the distinct
integers per dimension with one dictionary code per vector. Against a codebook a table of
squared differences is worked out per dimension, distinct integers times entries; the
distances of all vectors of the block are then gathered from the tables by code and added
up. A block bounds what a task holds, whatever values occur.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.sources.staging import stage

SCALE = 1024
PARTS = 4
ENTRIES = 256  # two hexadecimal digits
ROUNDS = 4
BLOCK_ROWS = 2048
WIDEST = 2**62  # integers of a component stay inside 64 bits, and so do their differences


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, entry and position within the part, as integers of ``SCALE``-ths."""

    entries: np.ndarray  # (parts, entries, width) of int64

    def digest(self) -> str:
        """SHA-256 of all integers by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


@dataclass(frozen=True)
class _Block:
    ids: pa.Array
    labels: pa.Array
    values: list[np.ndarray]  # the distinct integers of each dimension, ascending
    codes: np.ndarray  # (dimensions, rows)

    @classmethod
    def of(cls, row: dict) -> _Block:
        sizes = row["sizes"].as_py()
        values = np.split(np.frombuffer(row["integers"].as_py(), np.int64), np.cumsum(sizes)[:-1])
        codes = np.frombuffer(row["codes"].as_py(), np.uint16).reshape(len(sizes), -1)
        return cls(row["ids"].values, row["labels"].values, values, codes)

    def integers(self) -> np.ndarray:
        return np.stack([v[c] for v, c in zip(self.values, self.codes, strict=True)], axis=1)


def _blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[_Block]:
    names = ["ids", "labels", "integers", "sizes", "codes"]
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Block.of({n: batch.column(n)[i] for n in names})


def integer_blocks(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Blocks of kept vectors of one length: ids, labels, dictionaries and codes.

    Left out are rows whose vector is null, empty, or holds a null, a component that is not
    finite, or one whose integer does not fit 63 bits.
    """
    rows = vectors.select(
        F.col(id_col).alias("ids"),
        F.col(label_col).alias("labels"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    kinds = rows.schema
    schema = T.StructType(
        [
            T.StructField("width", T.IntegerType()),
            T.StructField("ids", T.ArrayType(kinds["ids"].dataType)),
            T.StructField("labels", T.ArrayType(kinds["labels"].dataType)),
            T.StructField("integers", T.BinaryType()),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("codes", T.BinaryType()),
        ]
    )

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = pc.fill_null(pc.list_value_length(batch.column("vector")), 0).to_numpy()
            for width in np.unique(widths[widths > 0]).tolist():
                same = batch.filter(pa.array(widths == width))
                for start in range(0, same.num_rows, BLOCK_ROWS):
                    block = _encoded(same.slice(start, BLOCK_ROWS), width)
                    if block is not None:
                        yield block

    return rows.mapInArrow(encode, schema)


def _encoded(rows: pa.RecordBatch, width: int) -> pa.RecordBatch | None:
    """One block of vectors of this length; None if no row is kept."""
    flat = rows.column("vector").flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(flat.reshape(-1, width) * SCALE)
        kept = (np.abs(scaled) < WIDEST).all(axis=1)  # false for NaN and infinity too
    if not kept.any():
        return None
    integers = scaled[kept].astype(np.int64)
    rows = rows.filter(pa.array(kept))
    values, codes = zip(*[np.unique(c, return_inverse=True) for c in integers.T], strict=True)

    def listed(column: str) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(column))

    columns = {
        "width": pa.array([width], pa.int32()),
        "ids": listed("ids"),
        "labels": listed("labels"),
        "integers": pa.array([np.concatenate(values).tobytes()], pa.binary()),
        "sizes": pa.array([[len(v) for v in values]], pa.list_(pa.int32())),
        "codes": pa.array([np.stack(codes).astype(np.uint16).tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _nearest(block: _Block, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every part and row the nearest entry, the lower index on ties, and its distance."""
    parts, entries, width = books.shape
    low = min([int(books.min()), *[int(v[0]) for v in block.values]])
    spread = max([int(books.max()), *[int(v[-1]) for v in block.values]]) - low
    largest = spread * spread * width
    kind = np.int32 if largest < 2**31 else np.int64 if largest < 2**63 else object
    rows = block.codes.shape[1]
    chosen = np.empty((parts, rows), dtype=np.int64)
    away = np.empty((parts, rows), dtype=kind)
    distances = np.empty((rows, entries), dtype=kind)
    gathered = np.empty_like(distances)
    for part in range(parts):
        distances.fill(0)
        for at in range(width):
            dimension = part * width + at
            value = (block.values[dimension] - low).astype(kind)
            table = value[:, None] - (books[part, :, at] - low).astype(kind)
            np.take(table * table, block.codes[dimension], axis=0, out=gathered, mode="clip")
            distances += gathered
        chosen[part] = distances.argmin(axis=1)
        away[part] = distances[np.arange(rows), chosen[part]]
    return chosen, away


def _entry_sums(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """How many parts each entry is nearest to, and their sum per position."""
    parts, entries, width = books.shape

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, width, entries), dtype=object)
        for block in _blocks_of(batches):
            chosen, _ = _nearest(block, books)
            for part in range(parts):
                counts[part] += np.bincount(chosen[part], minlength=entries)
                for at in range(width):
                    dimension = part * width + at
                    sums[part, at] += _sums(
                        block.values[dimension], block.codes[dimension], chosen[part], entries
                    )
        for part, entry in zip(*np.nonzero(counts), strict=True):
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "entry": pa.array([entry], pa.int32()),
                    "n": pa.array([counts[part, entry]], pa.int64()),
                    "sums": pa.array([[str(s) for s in sums[part, :, entry]]], pa.list_(pa.string())),
                }
            )

    partial = blocks.mapInArrow(tally, "part int, entry int, n bigint, sums array<string>")
    each = partial.select("part", "entry", "n", F.posexplode("sums").alias("position", "s"))
    return each.groupBy("part", "entry", "position").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )


def _sums(values: np.ndarray, codes: np.ndarray, entry: np.ndarray, entries: int) -> np.ndarray:
    """Sum of the integers that fall to each entry, exact."""
    if max(abs(int(values[0])), abs(int(values[-1]))) * len(codes) < 2**53:
        return np.bincount(entry, weights=values[codes], minlength=entries).astype(np.int64)
    sums = np.zeros(entries, dtype=object)
    np.add.at(sums, entry, values[codes].astype(object))
    return sums


def fit_codebooks(
    blocks: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks | None:
    """Codebooks after so many rounds of assignment and replacement; None without vectors.

    They start as the parts of the vectors with the smallest ids; equal ids are ordered by
    their integers and a null id comes last. Fewer vectors than entries give as many
    entries. An entry that no part is nearest to stays as it is. The driver holds codebooks
    and one sum per number in them.
    """
    widths = blocks.agg(F.min("width").alias("low"), F.max("width").alias("high")).first()
    if widths.low is None:
        return None
    if widths.low != widths.high or widths.low % parts:
        raise ValueError(f"vectors of one length that {parts} divides are needed, found {widths}")

    def smallest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches):
            ids, integers = block.ids.to_pylist(), block.integers()
            order = heapq.nsmallest(
                entries, range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, tuple(integers[i]))
            )
            yield pa.RecordBatch.from_pydict(
                {
                    "id": block.ids.take(pa.array(order)),
                    "integers": pa.array(integers[order].tolist(), pa.list_(pa.int64())),
                }
            )

    kind = blocks.schema["ids"].dataType.elementType
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("integers", T.ArrayType(T.LongType()))]
    )
    first = blocks.select("ids", "labels", "integers", "sizes", "codes").mapInArrow(smallest, schema)
    start = first.orderBy(F.asc_nulls_last("id"), "integers").limit(entries).collect()
    whole = np.array([r.integers for r in start], dtype=np.int64)
    books = np.stack(np.split(whole, parts, axis=1))
    for _ in range(rounds):
        for r in _entry_sums(blocks, books).collect():
            books[r.part, r.entry, r.position] = int(r.s) // r.n
    return Codebooks(books)


def encoded(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """Columns ids, labels, code and error of every vector in the blocks."""
    entries = books.entries

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches):
            chosen, away = _nearest(block, entries)
            texts = [bytes(row).hex() for row in chosen.T.astype(np.uint8)]
            errors = [int(e) for e in away.astype(object).sum(axis=0)]
            yield pa.RecordBatch.from_pydict(
                {
                    "ids": block.ids,
                    "labels": block.labels,
                    "code": pa.array(texts, pa.string()),
                    "error": pa.array([e if e < 2**63 else None for e in errors], pa.int64()),
                }
            )

    kinds = blocks.schema
    schema = T.StructType(
        [
            T.StructField("ids", kinds["ids"].dataType.elementType),
            T.StructField("labels", kinds["labels"].dataType.elementType),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )
    return blocks.drop("width").mapInArrow(encode, schema)


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The id column, code, error, label_error and codebooks_sha256 of every kept vector.

    ``error`` is the squared distance of the vector to its entries, ``label_error`` its sum
    over equal labels (null labels are equal); what does not fit 64 bits is null. Rows that
    ``integer_blocks`` leaves out are not in the result; repeated rows and null ids are. An
    empty table gives an empty result, vectors of several lengths an error.

    Each label's errors are summed before they are shuffled, and the sums come back by an
    equi-join whose large partitions adaptive execution splits.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two digits has 1 to 256 entries")
    blocks = stage(integer_blocks(vectors, id_col, vector_col, label_col))
    books = fit_codebooks(blocks, parts, entries, rounds)
    coded = stage(encoded(blocks, books or Codebooks(np.zeros((parts, 1, 1), dtype=np.int64))))
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    totals = coded.groupBy(F.col("labels").alias("label")).agg(total.alias("label_error"))
    summed = coded.join(stage(totals), F.col("labels").eqNullSafe(F.col("label")))
    return summed.select(
        F.col("ids").alias(id_col),
        "code",
        "error",
        "label_error",
        F.lit(books.digest() if books else "").alias("codebooks_sha256"),
    )
