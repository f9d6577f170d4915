"""Language identification: a sparse multinomial logistic regression on character n-grams.

Features are TF-IDF weights of hashed character n-grams of orders 1 to 3, with everything
that is not a letter read as a blank. Document frequencies come from all documents that may
be learned from. The weights are fitted by follow-the-regularised-leader with L1 and L2
penalties on a bounded sample, and a temperature is fitted on a part of the sample that the
weights have not seen.

Texts are counted many at a time: the n-grams of a slice of texts become one sorted list of
(text, bucket) pairs, and only the weights of buckets that occur and are not zero for every
language take part in the products. A short text costs in proportion to its n-grams.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.batches import parts_by_text
from arrears.sources.staging import stage

ORDERS = 3
BUCKETS = 1 << 16
FIT_ROWS = 4_000  # rows that the weights are fitted on, shared evenly by the languages
EPOCHS = 4
ALPHA, BETA = 0.5, 1.0  # learning rate of the leader
L1, L2 = 0.05, 0.5  # penalties
CALIBRATE = 5  # one of so many sampled rows is kept for the temperature
UNKNOWN = "und"
MAX_LANGUAGES = 256  # the weights have so many columns at most
SLICE_BYTES = 250_000  # text that is counted at once
PIECE = 500_000  # characters whose n-grams are hashed at once; a longer text takes several


class Letters:
    """Which code points are letters, as a table over those below the last one met."""

    def __init__(self) -> None:
        self.table = np.array([chr(i).isalpha() for i in range(0x3000)])

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        if len(codes) and codes.max() >= len(self.table):
            far = range(len(self.table), sys.maxunicode + 1)
            self.table = np.concatenate([self.table, [chr(i).isalpha() for i in far]])
        return self.table[codes]


def ngram_counts(
    texts: Sequence[str], letters: Letters, buckets: int = BUCKETS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of hashed n-grams: number of the text, bucket and count, in this order.

    A text without a letter has none. Letters are lowered, what is between them becomes one
    blank, and a blank stands at both ends.
    """
    encoded = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    sizes = np.array([len(e) // 4 for e in encoded], dtype=np.int64)
    codes = np.frombuffer(b"".join(encoded), dtype="<u4")
    text = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    known = letters(codes)
    kept = known.copy()
    kept[1:] |= known[:-1] & (text[1:] == text[:-1])  # one blank between two words
    lengths = np.bincount(text[kept], minlength=len(texts))
    own = np.flatnonzero(np.bincount(text[known], minlength=len(texts)))
    ends = np.cumsum(lengths[own] + 2)
    place = np.zeros(len(texts), dtype=np.int64)
    place[own] = ends - lengths[own] - 1
    kept &= np.isin(text, own) if len(own) < len(texts) else True
    line = np.full(int(ends[-1]) if len(own) else 0, 32, dtype=np.uint64)
    within = np.arange(int(kept.sum())) - np.repeat(np.cumsum(lengths[own]) - lengths[own], lengths[own])
    line[place[text[kept]] + within] = np.where(known, codes, 32)[kept]
    owner = np.repeat(own, lengths[own] + 2)
    keys, counts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for start in range(0, len(line), PIECE):
        piece = line[start : start + PIECE + ORDERS - 1]
        of, n = owner[start : start + PIECE + ORDERS - 1], min(PIECE, len(line) - start)
        h, found = np.zeros(len(piece), dtype=np.uint64), []
        for order in range(ORDERS):
            h = h[: max(len(piece) - order, 0)] * np.uint64(0x100000001B3) + piece[order:] + np.uint64(order)
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            at = ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            inside = (of[: len(h)] == of[order:])[:n]
            found.append((of[: len(h)] * buckets + at)[:n][inside])
        key, count = np.unique(np.concatenate(found), return_counts=True)
        keys.append(key)
        counts.append(count)
    key, count = np.concatenate(keys), np.concatenate(counts)
    if len(keys) > 2:  # a text may go on in the next piece
        key, back = np.unique(key, return_inverse=True)
        count = np.bincount(back, weights=count).astype(np.int64)
    return key // buckets, key % buckets, count


@dataclass(frozen=True)
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x labels; most are zero
    temperature: float

    def logits(self, n: int, text: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One row per text, from what `ngram_counts` gives for ``n`` texts."""
        x = counts * self.idf[at]
        norms = np.sqrt(np.bincount(text, weights=x * x, minlength=n))
        used = self.weights.any(axis=1)[at]
        text, at, x = text[used], at[used], x[used]
        sums = [np.bincount(text, weights=x * w[at], minlength=n) for w in self.weights.T]
        return np.stack(sums, axis=1) / np.where(norms > 0, norms, 1.0)[:, None]

    def predict(self, texts: Sequence[str], letters: Letters) -> tuple[list[str], np.ndarray]:
        """The language of each text and its calibrated probability."""
        text, at, counts = ngram_counts(texts, letters, len(self.idf))
        known = np.bincount(text, minlength=len(texts)) > 0
        if not self.labels or not len(texts):
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = _softmax(self.logits(len(texts), text, at, counts) / self.temperature)
        best = p.argmax(axis=1)
        names = [self.labels[k] if yes else UNKNOWN for k, yes in zip(best.tolist(), known.tolist(), strict=True)]
        return names, np.where(known, p[np.arange(len(texts)), best], 0.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


Example = tuple[np.ndarray, np.ndarray, int]  # buckets, values, label


def follow_the_leader(
    examples: Sequence[Example], labels: int, buckets: int, epochs: int = EPOCHS,
    alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2,
) -> np.ndarray:
    """FTRL-proximal with a learning rate per coordinate; weights below the L1 penalty are 0."""
    z = np.zeros((buckets, labels))
    n = np.zeros((buckets, labels))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * l1 - z
        return np.where(np.abs(z) <= l1, 0.0, shrunk / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for at, x, label in examples:
            own_z, own_n = z[at], n[at]
            w = weights(own_z, own_n)
            p = _softmax(x @ w)
            p[label] -= 1.0
            g = x[:, None] * p[None, :]
            squared = own_n + g * g
            z[at] = own_z + g - (np.sqrt(squared) - np.sqrt(own_n)) / alpha * w
            n[at] = squared
    return weights(z, n)


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section; 1 without rows."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text leaves 1 by 3.

    A document without an id counts as held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def fit(
    docs: DataFrame, fit_rows: int = FIT_ROWS, buckets: int = BUCKETS, max_languages: int = MAX_LANGUAGES
) -> Model:
    """Learn from ``text`` and non-null ``lang`` of ``docs``, all rows of which may be used.

    Document frequencies count every row. The weights come from at most about ``fit_rows``
    rows, chosen by a hash of id and text, as many of each language where there are enough;
    the driver holds their sparse counts and the fixed table of frequencies. More than
    ``max_languages`` different values of lang are an error: the weights of all of them
    have to fit a task.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_languages + 1)
    sizes = {r.lang: r["n"] for r in counted.collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"lang has more than {max_languages} different values")
    labels = sorted(sizes)
    if not labels:
        return Model([], np.zeros(buckets), np.zeros((buckets, 0)), 1.0)
    each = max(1, fit_rows // len(labels))
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("fit")), F.lit(1 << 30))
    limit = F.create_map(
        [F.lit(x) for k in labels for x in (k, float(min(1.0, each / sizes[k]) * (1 << 30)))]
    )[F.col("lang")]
    marked = rows.select("text", "lang", (place < limit).alias("chosen"), place.alias("place"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        frequency = np.zeros(buckets, dtype=np.int64)
        n = 0
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        names = ["lang", "place", "at", "counts"]

        def record(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for part, texts in parts_by_text(batches, "text", SLICE_BYTES):
            text, at, counts = ngram_counts(texts, letters, buckets)
            frequency += np.bincount(at, minlength=buckets)
            n += len(texts)
            ends = np.searchsorted(text, np.arange(len(texts) + 1))
            rest = [part.column(c).to_pylist() for c in ("lang", "place", "chosen")]
            out = [
                (lang, place_, at[a:b].astype(np.int32), counts[a:b])
                for a, b, lang, place_, chosen in zip(ends, ends[1:], *rest, strict=False)
                if chosen and b > a
            ]
            if out:
                yield record(out)
        at = np.flatnonzero(frequency)
        if n:  # a row without a language: document frequencies, and the number of texts
            yield record([(None, n, at.astype(np.int32), frequency[at])])

    found = stage(marked.mapInArrow(run, "lang string, place bigint, at array<int>, counts array<bigint>"))
    totals = found.where("lang IS NULL")
    n = totals.agg(F.sum("place")).first()[0] or 0
    frequency = np.zeros(buckets)
    summed = (
        totals.select(F.explode(F.arrays_zip("at", "counts")).alias("x"))
        .groupBy(F.col("x.at").alias("at"))
        .agg(F.sum("x.counts").alias("n"))
    )
    for r in summed.collect():  # at most one row per bucket
        frequency[r["at"]] = r["n"]
    idf = np.log((1 + n) / (1 + frequency))
    examples: list[Example] = []
    apart: list[Example] = []
    sample = found.where("lang IS NOT NULL").collect()
    for r in sorted(sample, key=lambda r: (r.place, r.lang)):
        at = np.array(r["at"], dtype=np.int64)
        x = np.array(r["counts"], dtype=float) * idf[at]
        norm = np.sqrt(x @ x)
        example = (at, x / (norm if norm > 0 else 1.0), labels.index(r.lang))
        (apart if r.place % CALIBRATE == 0 else examples).append(example)
    weights = follow_the_leader(examples, len(labels), buckets)
    logits = np.array([x @ weights[at] for at, x, _ in apart]).reshape(len(apart), len(labels))
    temperature = fitted_temperature(logits, np.array([y for _, _, y in apart], dtype=int))
    return Model(labels, idf, weights, temperature)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (the calibrated probability) for every document.

    Reads ``doc_id`` and ``text`` only. A null text, or one without a letter, is ``und``
    with score 0, and so is every text where no language was learned.
    """
    fixed = (model.labels, model.idf, model.weights, model.temperature)
    shared = docs.sparkSession.sparkContext.broadcast(fixed)  # at most buckets x max_languages

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        model = Model(*shared.value)
        for part, texts in parts_by_text(batches, "text", SLICE_BYTES):
            names, scores = model.predict(texts, letters)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def identified(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Learn from the documents that are not held out, predict for all.

    Returns doc_id, held_out, lang_pred, score. Repeated rows give repeated results, an
    empty table an empty one.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"))), fit_rows)
    found = predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
