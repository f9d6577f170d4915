"""Quality by importance resampling with hashed n-gram models.

Two generative models of hashed word n-grams are counted: one of the target text (documents
labelled good), one of the raw text (all documents). The importance of a passage is the
ratio of its likelihoods under the two; a document counts by its least likely passage, as a
single bad passage spoils it however long the rest is. Documents are then sampled without
replacement, in proportion to a power of their importance: the k largest of log-importance
plus Gumbel noise. k is the number of documents that score like good ones.

Tokens are runs of letters, digits and non-ASCII characters, or runs of other visible ones.
N-grams are single tokens, cut to a stem so that the forms of a word share their evidence,
and pairs of whole tokens; a pair of equal tokens is one n-gram whatever the token.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.batches import fresh, parts_by_text
from arrears.sources.staging import stage

SINGLES, PAIRS = 1 << 19, 1 << 18  # buckets of the two orders
BUCKETS = SINGLES + PAIRS
REPEAT = SINGLES  # the bucket of a pair of equal tokens
SINGLE_PRIOR, PAIR_PRIOR = 1.0, 20.0  # target counts that pull a bucket's ratio towards 1
PASSAGE = 4  # tokens
STEM = 5  # bytes of a token that count when it stands alone
LABELLED_ROWS = 40_000  # labelled documents that are used, at most
HELD_OUT = 5  # one of so many of them sets the cut and is not counted as target
SHARPNESS = 40.0  # the power of the importance in the sampling
KEEP_WEIGHT = 3.0  # a good document that goes costs as much as so many bad ones that stay
SEED = 17
TEXT_BYTES = 500_000  # text whose tokens are hashed at once
SLICES = 96  # the count tables travel in so many pieces

_KIND = np.full(256, 2, dtype=np.int8)  # 0 blank or control, 1 word, 2 other visible
_KIND[:33] = 0
_KIND[127:] = 1
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), 95]] = 1
_RADIX = 0x9E3779B97F4A7C15 | 1


class Tokens:
    """Hashed tokens of many texts at once, by prefix sums of a polynomial in the bytes."""

    def __init__(self) -> None:
        self.size = 0

    def _grow(self, size: int) -> None:
        if size > self.size:
            self.size = max(size, 2 * self.size)
            step = np.full(self.size, _RADIX, dtype=np.uint64)
            back = np.full(self.size, pow(_RADIX, -1, 1 << 64), dtype=np.uint64)
            step[0] = back[0] = 1
            self.powers, self.inverse = np.cumprod(step), np.cumprod(back)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of every token, hash of its stem, and the text that it belongs to."""
        coded = [t.lower().encode() for t in texts]
        data = np.frombuffer(b" ".join(coded) + b" ", dtype=np.uint8)
        self._grow(len(data))
        kind = _KIND[data]
        edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]])
        end = np.r_[edge[1:], len(data)]
        real = kind[edge] > 0
        start, end = edge[real], end[real]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])

        def hashed(end: np.ndarray) -> np.ndarray:
            h = (sums[end] - sums[start]) * self.inverse[start]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return h ^ (h >> np.uint64(29))

        owner = np.searchsorted(np.cumsum([len(c) + 1 for c in coded]), start, side="right")
        return hashed(end), hashed(np.minimum(end, start + STEM)), owner


def ngrams(
    tokens: np.ndarray, stems: np.ndarray, owner: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every stem, and of the pair that begins with its token (-1 at a text's end)."""
    single = (stems >> np.uint64(40)) % np.uint64(SINGLES)
    pair = np.full(len(tokens), -1, dtype=np.int64)
    if len(tokens) > 1:
        mixed = (tokens[:-1] * np.uint64(0x100000001B3)) ^ tokens[1:]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        at = SINGLES + 1 + ((mixed >> np.uint64(40)) % np.uint64(PAIRS - 1)).astype(np.int64)
        at = np.where(tokens[:-1] == tokens[1:], REPEAT, at)
        pair[:-1] = np.where(owner[:-1] == owner[1:], at, -1)
    return single.astype(np.int64), pair


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed models, per bucket; zeros where nothing was counted."""
    out = np.zeros(BUCKETS, dtype=np.float32)
    for part, prior in ((slice(0, SINGLES), SINGLE_PRIOR), (slice(SINGLES, BUCKETS), PAIR_PRIOR)):
        t, r = target[part].astype(float), raw[part].astype(float)
        if t.sum() and r.sum():
            out[part] = np.log((t + prior) / (r * (t.sum() / r.sum()) + prior))
    return out


def lowest_passages(texts: list[str], ratios: np.ndarray, tokens: Tokens) -> np.ndarray:
    """For each text the lowest sum of log ratios over ``PASSAGE`` tokens in a row.

    A shorter text is one passage, one without tokens scores 0.
    """
    *hashes, owner = tokens(texts)
    single, pair = ngrams(*hashes, owner)
    value = ratios[single] + np.where(pair >= 0, ratios[pair], np.float32(0))
    value = np.concatenate([value.astype(float), np.zeros(PASSAGE)])
    n = len(owner)
    begins = np.searchsorted(owner, np.arange(len(texts) + 1))
    sizes = np.diff(begins)
    lowest = np.zeros(len(texts))
    # Added up token by token, so a text scores the same whatever it shares a batch with.
    passage = np.zeros(n)
    for i in range(PASSAGE):
        passage += value[i : n + i] * (np.arange(n) + i < begins[1:][owner])
    # A text's first passage counts always, a later one only if it is whole.
    counts = np.arange(n) + PASSAGE <= begins[1:][owner]
    counts[begins[:-1][sizes > 0]] = True
    if n:
        inside = np.flatnonzero(counts)
        first = np.searchsorted(inside, begins[:-1][sizes > 0])
        lowest[sizes > 0] = np.minimum.reduceat(passage[inside], first)
    return lowest



@dataclass(frozen=True)
class Labels:
    """A bounded sample of labelled ids, each list sorted."""

    target: list[int]  # counted as target text
    held_good: list[int]  # these two set the cut
    held_bad: list[int]


def sampled_labels(labels: DataFrame, rows: int = LABELLED_ROWS, apart: int = HELD_OUT) -> Labels:
    """Ids of good documents (quality 1 and not toxic) and of others, chosen by a hash.

    An id with several labels takes the worst of each; a null quality is no label, a null
    toxic counts as not toxic.
    """
    worst = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    )
    worst = stage(
        worst.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"),
            F.pmod(F.xxhash64("doc_id", F.lit("labels")), F.lit(1 << 30)).alias("place"),
        )
    )
    n = worst.count()
    share = min(1.0, rows / max(n, 1))
    chosen = worst.where(F.col("place") < share * (1 << 30)).collect()
    held = [r for r in chosen if r.place % apart == 0]
    return Labels(
        sorted(r.doc_id for r in chosen if r.good and r.place % apart),
        sorted(r.doc_id for r in held if r.good),
        sorted(r.doc_id for r in held if not r.good),
    )


def count_ngrams(docs: DataFrame, target: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over the target documents and over all documents.

    Each task adds up its documents and sends its two tables in pieces; the pieces are
    added in as many groups. The driver gets one table of fixed size.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(np.array(target, dtype=np.int64))
    width = BUCKETS // SLICES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        counts = np.zeros((2, BUCKETS), dtype=np.int64)
        seen = False
        for part, texts in parts_by_text(batches, "text", TEXT_BYTES):
            seen = True
            *hashes, owner = tokens(texts)
            single, pair = ngrams(*hashes, owner)
            ids = part.column("doc_id").fill_null(-(2**63)).to_numpy()
            chosen = np.isin(ids, wanted.value)[owner]
            for row, keep in ((0, chosen), (1, slice(None))):
                some = pair[keep]
                counts[row] += np.bincount(single[keep], minlength=BUCKETS)
                counts[row] += np.bincount(some[some >= 0], minlength=BUCKETS)
        if seen:
            pieces = counts.reshape(2, SLICES, width)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(SLICES), pa.int32()),
                    pa.array([p.tobytes() for p in pieces[0]]),
                    pa.array([p.tobytes() for p in pieces[1]]),
                ],
                names=["slice", "target", "raw"],
            )

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, *tables in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                own = np.stack([np.frombuffer(t, dtype=np.int64) for t in tables])
                totals[at] = totals[at] + own if at in totals else own
        if totals:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(totals), pa.int32()),
                    pa.array([t[0].tobytes() for t in totals.values()]),
                    pa.array([t[1].tobytes() for t in totals.values()]),
                ],
                names=["slice", "target", "raw"],
            )

    kinds = "slice int, target binary, raw binary"
    pieces = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, kinds)
    summed = pieces.repartition("slice").mapInArrow(add, kinds)
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    for r in summed.collect():  # SLICES rows
        at = slice(r["slice"] * width, (r["slice"] + 1) * width)
        counts[0, at] = np.frombuffer(r["target"], dtype=np.int64)
        counts[1, at] = np.frombuffer(r["raw"], dtype=np.int64)
    return counts[0], counts[1]


def best_cut(good: list[float], bad: list[float], keep_weight: float = KEEP_WEIGHT) -> float:
    """The score that parts held-out good and bad documents at the least cost.

    The cost is ``keep_weight`` times the share of good ones below plus the share of bad
    ones at or above. Between two scores the middle is taken. Without either kind nothing
    is cut.
    """
    if not good or not bad:
        return float("-inf")
    scores = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[scores[0] - 1], (scores[1:] + scores[:-1]) / 2, [scores[-1] + 1]])
    below = np.searchsorted(np.sort(good), cuts) / len(good)
    above = 1 - np.searchsorted(np.sort(bad), cuts) / len(bad)
    return float(cuts[np.argmin(keep_weight * below + above)])


def gumbel(seed: int, *of: str) -> Column:
    """Gumbel noise that depends on the values of some columns and the seed alone."""
    u = (F.pmod(F.xxhash64(*of, F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(rows: DataFrame, column: str, k: int, parts: int = 1024) -> float:
    """The k-th largest value, found by counting ever finer ranges of values."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n:
        return low
    above = 0  # values known to be above ``high``
    while low < high:
        width = (high - low) / parts
        at = F.least(F.floor((F.col(column) - low) / width), F.lit(parts - 1)) if width > 0 else F.lit(0)
        inside = rows.where((F.col(column) >= low) & (F.col(column) <= high))
        held = (
            inside.groupBy(at.alias("at"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .collect()
        )
        for r in sorted(held, key=lambda r: -r["at"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
        if len(held) == 1 and width == 0:
            break
    return low


def _with_importance(docs: DataFrame, ratios: np.ndarray, names: list[str], result: str) -> DataFrame:
    """The named columns of ``docs`` and the log-importance of its texts as ``result``."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # fixed size: 3 MB

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for part, texts in parts_by_text(batches, "text", TEXT_BYTES):
            found = pa.array(lowest_passages(texts, shared.value, tokens))
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names] + [found], names=[*names, result]
            )

    own = docs.select(*dict.fromkeys([*names, "text"]))
    kinds = T.StructType([own.schema[n] for n in names])
    return own.mapInArrow(run, kinds.add(result, T.DoubleType()))


@dataclass(frozen=True)
class Classifier:
    """The log ratio of every bucket, and the smallest key that is sampled."""

    ratios: np.ndarray
    threshold: float


def _key(importance: str, doc_id: str, text_hash: str) -> Column:
    return F.col(importance) * SHARPNESS + gumbel(SEED, doc_id, text_hash)


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> tuple[Classifier, DataFrame]:
    """The classifier for ``docs``, and their doc_id, log_importance and sampling key."""
    sample = sampled_labels(labels, labelled_rows)
    target, raw = count_ngrams(docs, sample.target)
    ratios = log_ratios(target, raw)
    own = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    scored = stage(_with_importance(own, ratios, ["doc_id", "text_hash"], "log_importance"))
    keyed = scored.withColumn("key", _key("log_importance", "doc_id", "text_hash")).drop("text_hash")
    good, known = set(sample.held_good), sample.held_good + sample.held_bad
    held = scored.where(F.col("doc_id").isin(known)).collect() if known else []
    cut = best_cut(
        [r.log_importance for r in held if r.doc_id in good],
        [r.log_importance for r in held if r.doc_id not in good],
    )
    k = scored.where(F.col("log_importance") >= cut).count()
    threshold = kth_largest(keyed, "key", k) if k else float("inf")
    return Classifier(ratios, threshold), keyed


def classify(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """doc_id, log_importance, sampling key and whether the document is kept, for all.

    Reads doc_id and text of ``docs``; doc_id, quality and toxic of ``labels``. Both models
    see whole texts, the raw one those of all documents. The target and the cut come from a
    sample of at most about ``labelled_rows`` labelled documents; a held-out part of it
    sets the cut. k is the number of documents whose importance reaches the cut, and the k
    largest keys are kept (with any that tie with the last).

    Null and empty texts have importance 1 (log 0). Without labels of both kinds everything
    is kept. Repeated rows share their noise and stay or go together; a null id is never
    labelled. An empty table gives an empty result.
    """
    model, keyed = fit(docs, labels, labelled_rows)
    return keyed.withColumn("kept", F.col("key") >= model.threshold)


def kept_documents(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns.

    Each row is scored once more as it passes, which costs less than moving all texts to
    join them with the decisions.
    """
    model, _ = fit(docs, labels, labelled_rows)
    importance, own_id, own_text = (fresh(docs, n) for n in ("_importance", "_id", "_text"))
    own = docs.withColumns({own_id: F.col("doc_id").cast("bigint"), own_text: F.xxhash64("text")})
    scored = _with_importance(own, model.ratios, own.columns, importance)
    return scored.where(_key(importance, own_id, own_text) >= model.threshold).select(*docs.columns)
