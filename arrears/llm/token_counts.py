"""Numbers of tokens, without the tokens."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.batches import spans_by_size
from arrears.llm.pieces import PieceModel, safe_parts

PART_CHARACTERS = 20_000  # a longer text goes to the encoder in parts
BATCH_BYTES = 500_000  # text that the encoder gets at once, about


def token_counts(
    docs: DataFrame,
    model: bytes,
    limit: int = 4096,
    part_characters: int = PART_CHARACTERS,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) per document.

    Batches for the encoder hold about ``batch_bytes`` of text, whatever the number of
    rows, and a long text enters in parts cut where no piece can reach across, so memory
    follows the batch size and not the longest text. A model whose pieces allow no such
    cut gets whole texts. Only lengths leave Python.

    Reads ``doc_id`` and ``text`` only. A null text is the empty text: 0 bytes, 0 tokens.
    Repeated rows give repeated results, an empty table an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def counts(texts: list[str], pieces: PieceModel, processor) -> list[int]:
        parts, owners = [], []
        for i, text in enumerate(texts):
            own = safe_parts(text, part_characters) if pieces.cuts_at_spaces else [text]
            parts += own
            owners += [i] * len(own)
        found = [0] * len(texts)
        for start, end in spans_by_size([len(p) for p in parts], batch_bytes):
            ids = processor.encode(parts[start:end], num_threads=1)
            for owner, own in zip(owners[start:end], ids, strict=True):
                found[owner] += len(own)
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel(shared.value)
        processor = pieces.processor()
        for batch in batches:
            texts = batch.column("text")
            sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
            for start, end in spans_by_size(sizes, 4 * batch_bytes):
                part = batch.slice(start, end - start)
                own = [t or "" for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(sizes[start:end], pa.int64()),
                        pa.array(counts(own, pieces, processor), pa.int64()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    counted = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
