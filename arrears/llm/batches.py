"""Small helpers for functions that see Arrow batches of texts inside a task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def spans_by_size(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to ``limit`` at most, or that hold one item."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def parts_by_text(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = 1_000_000
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about ``limit`` bytes of text, and their texts (null: empty).

    What a task holds beside the batch is then bounded by the limit and its longest text.
    """
    for batch in batches:
        texts = batch.column(column)
        sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
        for start, end in spans_by_size(sizes, limit):
            part = batch.slice(start, end - start)
            yield part, [t or "" for t in part.column(column).to_pylist()]
