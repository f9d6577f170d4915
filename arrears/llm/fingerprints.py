"""Order-independent document fingerprints that can be updated by single paragraphs.

A paragraph is a non-empty run of characters between line breaks. It is hashed to a wide
vector of two parts, and the fingerprint of a document is the sum of its paragraphs'
vectors, lane by lane, modulo 2^32:

* ``EXACT`` uniform lanes. They agree only where the multisets of paragraphs agree.
* ``SKETCH`` lanes into which the paragraph's character n-grams are counted with a hashed
  sign. The squared distance of two such sums estimates how many n-grams the documents do
  not share, whatever the order of paragraphs.

As the sum is homomorphic, inserting or deleting a paragraph adds or subtracts its vector.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.batches import spans_by_size

EXACT, SKETCH, GRAM = 8, 128, 5
LANES = EXACT + SKETCH
SLICE = 500_000  # code points that are hashed at once
BUCKET_ROWS = 2_000  # documents that are put in order together, about
BUCKETS = 4_096  # at most, so the driver holds this many bucket limits

_MULTIPLIERS = np.array(
    [pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(GRAM)], dtype=np.uint64
)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _gram_counts(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Signed counts per owner and lane of the n-grams without a line break."""
    found = np.zeros(n * SKETCH)
    for start in range(0, max(len(codes) - GRAM + 1, 0), SLICE):
        part = codes[start : start + SLICE + GRAM - 1]
        size = len(part) - GRAM + 1
        h = np.zeros(size, dtype=np.uint64)
        breaks = np.concatenate([[0], np.cumsum(part == 10)])
        for i in range(GRAM):
            h += part[i : i + size] * _MULTIPLIERS[i]
        inside = breaks[GRAM:] == breaks[:size]
        h = _mixed(h[inside])
        at = owner[start : start + size][inside] * SKETCH + (h >> np.uint64(57)).astype(np.int64)
        sign = 1.0 - 2.0 * ((h >> np.uint64(20)) & np.uint64(1)).astype(float)
        found += np.bincount(at, weights=sign, minlength=n * SKETCH)
    return found.reshape(n, SKETCH)


def vectors(texts: Sequence[str]) -> np.ndarray:
    """One row of LANES unsigned 32-bit sums per text; the empty text has zeros."""
    n = len(texts)
    out = np.zeros((n, LANES), dtype=np.uint32)
    for i, text in enumerate(texts):
        digests = b"".join(
            blake2b(p.encode(), digest_size=4 * EXACT + 8).digest() for p in text.split("\n") if p
        )
        if digests:
            own = np.frombuffer(digests, dtype="<u4").reshape(-1, EXACT + 2)
            out[i, :EXACT] = own[:, :EXACT].sum(axis=0, dtype=np.uint32)
            # A paragraph counts as one more n-gram, so that short ones count at all.
            sign = 1.0 - 2.0 * (own[:, EXACT + 1] & 1)
            lane = own[:, EXACT] % SKETCH
            counted = np.bincount(lane, weights=sign, minlength=SKETCH)
            out[i, EXACT:] = counted.astype(np.int64).astype(np.uint32)
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(n), [len(t) + 1 for t in texts])
    if n:
        out[:, EXACT:] += _gram_counts(codes, owner, n).astype(np.int64).astype(np.uint32)
    return out


def written(vector: np.ndarray) -> str:
    return base64.b64encode(vector.astype("<u4").tobytes()).decode()


def parsed(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u4").copy()


def inserted(fingerprint: str, text: str) -> str:
    """The fingerprint after the paragraphs of ``text`` have been added."""
    return written(parsed(fingerprint) + vectors([text])[0])


def deleted(fingerprint: str, text: str) -> str:
    """The fingerprint after the paragraphs of ``text`` have been taken away."""
    return written(parsed(fingerprint) - vectors([text])[0])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal fingerprints, about 0 for unrelated ones, row by row.

    The shared share of the n-grams: 2ab / (aa + bb) of the sketch lanes, cut to 0..1.
    """
    x = a[:, EXACT:].astype(np.int32).astype(float)
    y = b[:, EXACT:].astype(np.int32).astype(float)
    norm = (x * x).sum(1) + (y * y).sum(1)
    shared = 2 * (x * y).sum(1) / np.where(norm > 0, norm, 1)
    return np.where((a == b).all(1), 1.0, np.clip(shared, 0.0, 1.0))


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def _compared(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
    """Results for documents whose next documents' texts are ``following``."""
    share = [len(t) // 4 for t in texts]
    edited = [
        t[: len(t) - k] + f[:k] if k else t for t, f, k in zip(texts, following, share, strict=True)
    ]
    # A next document is mostly the next row, so hash each text once.
    places: dict[int, int] = {}
    distinct: list[str] = []
    for t in [*texts, *following]:
        if id(t) not in places:
            places[id(t)] = len(distinct)
            distinct.append(t)
    known = vectors(distinct)
    own = known[[places[id(t)] for t in texts]]
    after = known[[places[id(t)] for t in following]]
    changed = vectors(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([sha256(e.encode()).hexdigest() for e in edited]),
            pa.array([written(v) for v in own]),
            pa.array([written(v) for v in changed]),
            pa.array(likeness(own, changed), pa.float64()),
            pa.array(likeness(own, after), pa.float64()),
        ],
        names=RESULT.names,
    )


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs each row of a bucket with the next one; sorted rows in, results out.

    A bucket ends with a guard: the first document of the next bucket, which is compared
    with but has no result here.
    """
    bucket = last = None  # last: the row that still waits for its next one
    ids: list = []
    texts: list[str] = []
    following: list[str] = []
    for batch in batches:
        rows = zip(*[batch.column(c).to_pylist() for c in ("_bucket", "_guard", "doc_id", "text")], strict=True)
        for own, guard, doc_id, text in rows:
            text = text or ""
            if last and own == bucket:
                ids.append(last[0])
                texts.append(last[1])
                following.append(text)
            bucket, last = own, None if guard else (doc_id, text)
            if len(ids) >= 64 and sum(map(len, texts)) > SLICE or len(ids) >= 4000:
                yield _compared(ids, texts, following)
                ids, texts, following = [], [], []
    if ids:
        yield _compared(ids, texts, following)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how near they are.

    The edited text replaces the last quarter of the code points (rounded down) by as many
    first ones of the next document, in ascending doc_id, or all of them; after the last
    document comes the first. Reads ``doc_id`` and ``text`` only. A null text is the empty
    text and has the zero fingerprint. Null ids come first; equal ids are in the order of
    their texts. A table of one document has itself as the next. An empty table gives an
    empty result.

    The order comes from range buckets of the id. A bucket also gets a copy of the first
    document of the next bucket, so each row meets its next one with a single shuffle of
    the texts and no task sees more than the buckets it was dealt.
    """
    least = -(2**63)
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = F.coalesce("doc_id", F.lit(least))
    ids = keyed.select(order.alias("id"))
    n = ids.count()
    count = min(BUCKETS, max(1, n // BUCKET_ROWS))
    shares = [i / count for i in range(1, count)]
    cuts: list[int] = []
    if shares:
        found = ids.agg(F.percentile_approx("id", shares, 10 * BUCKETS)).first()[0]
        cuts = sorted(set(found))

    @F.pandas_udf("int")
    def bucket(id_: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, dtype=np.int64), id_.to_numpy(), side="left"))

    firsts = ids.groupBy(bucket("id").alias("b")).agg(F.min("id").alias("first")).collect()
    firsts = sorted((r.b, r["first"]) for r in firsts)
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    own = keyed.withColumn("_bucket", bucket(order)).withColumn("_guard", F.lit(False))
    if before:  # one row per bucket at least: its first document, once more
        entries = [x for k, b in before.items() for x in (F.lit(k).cast("bigint"), F.lit(b))]
        previous = F.create_map(entries)[order]
        copies = F.when(
            order.isin(list(before)),
            F.array(
                F.struct("_bucket", "_guard"),
                F.struct(previous.alias("_bucket"), F.lit(True).alias("_guard")),
            ),
        ).otherwise(F.array(F.struct("_bucket", "_guard")))
        own = own.select("doc_id", "text", F.inline(copies))
    return (
        own.repartition("_bucket")
        .sortWithinPartitions("_bucket", "_guard", F.col("doc_id").asc_nulls_first(), "text")
        .select("_bucket", "_guard", "doc_id", "text")
        .mapInArrow(_in_order, RESULT)
    )
