"""SentencePiece ids with the byte span of the source that each id stands for, and back."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arrears.llm.batches import parts_by_text
from arrears.llm.pieces import PieceModel

ENCODED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("ends", T.ArrayType(T.IntegerType(), False)),
        T.StructField("decoded", T.StringType()),
    ]
)


def _flat(lists: list, kind: np.dtype) -> pa.ListArray:
    sizes = np.fromiter((len(x) for x in lists), dtype=np.int64, count=len(lists))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.concatenate(lists) if lists else np.zeros(0, dtype=kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind)))


class Codec:
    """Encodes and decodes batches of texts. Build it inside a task."""

    def __init__(self, model: bytes) -> None:
        self.model = PieceModel(model)
        self.plain = self.model.plain_processor()
        self.whole = self.model.processor()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[np.ndarray]]:
        """Ids, and where the span of each id ends in the UTF-8 bytes of its text.

        The first span begins at 0 and each next one where the one before ends. A span is
        empty where a piece stands for no source byte, such as the space put before a text.
        """
        normal = [self.model.normalizer(t) for t in texts]
        strings = [data.decode() for data, _ in normal]
        if self.model.byte_fallback:
            ids = self.plain.encode(strings, num_threads=1)
            widths = [self.model.widths[i] for i in ids]
        else:  # an unknown piece is as wide as what it covers
            pieces = self.plain.encode(strings, out_type=str, num_threads=1)
            ids = [self.plain.piece_to_id(p) for p in pieces]
            widths = [np.array([len(x.encode()) for x in p], dtype=np.int64) for p in pieces]
        ends = [
            source[np.cumsum(w)] if len(w) else np.zeros(0, dtype=np.int64)
            for w, (_, source) in zip(widths, normal, strict=True)
        ]
        return ids, ends

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode(ids, num_threads=1)


def encode_decode(docs: DataFrame, model: bytes) -> DataFrame:
    """Ids, source spans and the decoded text of every document.

    ``model`` is the content of a model file (well under 1 MB for usual vocabularies; it
    goes to the executors as a broadcast variable). Reads ``doc_id`` and ``text`` only.
    Returns doc_id, n_bytes, ids, ends (past the last source byte of each id, in UTF-8
    bytes) and decoded. A null text is the empty text: no ids, decoded empty. Repeated rows
    give repeated results, an empty table an empty one. Texts are never cut.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for part, texts in parts_by_text(batches, "text", 1_000_000):
            ids, ends = codec.encode(texts)
            decoded = codec.decode(ids)
            sizes = [int(e[-1]) if len(e) else 0 for e in ends]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    _flat([np.array(i, dtype=np.int32) for i in ids], np.int32),
                    _flat(ends, np.int32),
                    pa.array(decoded, pa.string()),
                ],
                names=ENCODED.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)
