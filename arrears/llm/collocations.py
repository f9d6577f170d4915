"""The best-scoring phrases of each language, by best-first growth from their first words.

A phrase's score is the lowest over its cuts of ``1000 * a * n / (l * r)``. Cut after the
first word, ``a`` is at most ``r`` and ``l`` is the count of that word, so
``1000 * n / f(word)`` bounds the score of everything that grows from the word. Words are
the frontier, the rarest (highest bound) first. A round grows all phrases from a part of
it, word by word, keeps those that occur often enough, and scores them. As soon as a
language has enough surviving phrases, the lowest of the best tells how far its frontier
matters at all: the next round grows from just those words whose bound reaches it.

Rounds read a skeleton of the corpus: word numbers with a vocabulary per slice of text,
where rare words and ends of pieces are gaps. What a round may skip is decided by bitmaps
of hashed words and phrases of a fixed size; a false hit costs work and changes nothing,
as counts are made by the phrases themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.llm.batches import spans_by_size
from arrears.sources.staging import stage

LONGEST = 5
LEAST = 100  # occurrences of a phrase
BEST = 2000
UNKNOWN = "und"
FIRST_REACH, REACH_STEP = 32, 32  # counts, in multiples of the least, that rounds go up to
SLICE_BYTES = 1_000_000
# Rows of the skeleton are small: Parquet gathers at least a hundred in a page.
SKELETON_BYTES = 125_000
BATCH_BYTES = "8m"
HELD_KEYS = 500_000  # keys a task counts together
HELD_WORDS = 100_000  # distinct words a task counts before it passes them on
BITS = 24  # slots of a bitmap, as a power of two: 2 MB
TASK_ROWS = 20_000  # rows that are ranked together, about

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
GAP = b"\n"
SEED = 42


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of a few megabytes for the passes run inside, which all end there."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _slices(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[str, list[bytes]]]:
    """Words and gaps of the texts of one language in a slice; empty strings are no words."""
    for batch in batches:
        for lang in batch.column("lang").unique().to_pylist():
            texts = batch.filter(pc.equal(batch.column("lang"), lang)).column("text")
            sizes = pc.binary_length(texts).to_pylist()
            for start, end in spans_by_size(sizes, limit):
                said = GAP.join(texts.slice(start, end - start).cast(pa.binary()).to_pylist())
                yield lang, said.translate(LOWER).replace(GAP, b" \n ").split(b" ")
        pa.default_memory_pool().release_unused()


def word_counts(texts: DataFrame) -> DataFrame:
    """Columns lang, word and n over all texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for lang, words in _slices(batches, SLICE_BYTES):
            held.setdefault(lang, Counter()).update(words)
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from passed_on(held)
                held = {}
        yield from passed_on(held)

    def passed_on(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in held.items():
            counter.pop(GAP, None)
            counter.pop(b"", None)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(counter), pa.string()),
                    "word": pa.array(list(counter), pa.binary()).cast(pa.string()),
                    "n": pa.array(list(counter.values()), pa.int64()),
                }
            )

    partial = texts.mapInArrow(count, "lang string, word string, n bigint")
    return partial.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _word_keys(lang: str, words: Iterable[bytes]) -> np.ndarray:
    """The same as ``xxhash64(lang, word)`` of Spark."""
    seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)


def _longer(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of phrases that go on by a word."""
    mixed = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def with_keys(phrases: DataFrame) -> DataFrame:
    """Columns lang, phrase and key."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)
            words = [_word_keys(lang, phrase.encode().split(b" ")) for lang, phrase in pairs]
            keys = np.array([reduce(_longer, w[1:, None], w[:1])[0] for w in words], dtype=np.uint64)
            yield batch.append_column("key", pa.array(keys.view(np.int64)))

    return phrases.select("lang", "phrase").mapInArrow(hashed, "lang string, phrase string, key bigint")


class Bitmap:
    """Which keys may be in a set; it holds one bit per slot of hashed keys."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, keys: DataFrame) -> Bitmap:
        """Of a column key. The driver gets the bits, however many keys there are."""
        slot = F.shiftrightunsigned("key", 64 - BITS)
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))
        packed = keys.groupBy(F.floor(slot / 64).alias("at")).agg(F.bit_or(mask).alias("mask")).collect()
        words = np.zeros(2**BITS // 64, dtype=np.int64)
        for at, mask in packed:
            words[at] = mask
        return cls(words.view(np.uint64))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> np.uint64(64 - BITS)
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def skeleton(texts: DataFrame, frequent: Bitmap) -> DataFrame:
    """Rows of lang, words, their keys and numbers (32 bits each, 0 a gap) for slices of text."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _slices(batches, SKELETON_BYTES):
            found = list(dict.fromkeys(words))
            usable = [w not in (GAP, b"") for w in found]
            keys = _word_keys(lang, found)
            kept = np.array(usable) & frequent.holds(keys)
            numbers = np.where(kept, np.cumsum(kept), 0)
            number = dict(zip(found, numbers.tolist(), strict=True))
            number[b""] = -1
            ids = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
            ids = ids[ids >= 0]
            ids = ids[(ids > 0) | np.append(True, ids[:-1] > 0)] if len(ids) else ids
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang]),
                    "words": pa.array(
                        [[w for w, k in zip(found, kept, strict=True) if k]], pa.list_(pa.binary())
                    ),
                    "keys": pa.array([keys[kept].tobytes()], pa.binary()),
                    "numbers": pa.array([ids.tobytes()], pa.binary()),
                }
            )

    return texts.mapInArrow(write, "lang string, words array<binary>, keys binary, numbers binary")


class _Slice:
    """Numbers of a slice, with gaps around, and its vocabulary; number 0 has no word."""

    def __init__(self, lang: str, words: pa.Array, keys: bytes, numbers: bytes):
        self.lang = lang
        self.words = pa.concat_arrays([pa.array([None], pa.binary()), words.cast(pa.binary())])
        ids = np.frombuffer(numbers, np.int32).astype(np.int64)
        self.ids = np.concatenate([[0], ids, np.zeros(LONGEST + 1, dtype=np.int64)])
        self.keys = np.append(np.uint64(0), np.frombuffer(keys, np.uint64))

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        said = [self.words.take(pa.array(self.ids[at + j])) for j in range(size)]
        return pc.binary_join_element_wise(*said, b" ").cast(pa.string())

    def grouped(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions ordered by their phrase, and where each phrase begins among them."""
        code, room = self.ids[at], len(self.words)
        for j in range(1, size):
            if len(code) and int(code.max()) >= 2**62 // room:
                code = np.unique(code, return_inverse=True)[1]
            code = code * room + self.ids[at + j]
        order = np.argsort(code, kind="stable")
        code = code[order]
        return at[order], np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else order


def _read_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[_Slice]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Slice(
                batch.column("lang")[i].as_py(),
                batch.column("words")[i].values,
                batch.column("keys")[i].as_py(),
                batch.column("numbers")[i].as_py(),
            )


def grown(corpus: DataFrame, first: Bitmap, known: Mapping[int, Bitmap], size: int) -> DataFrame:
    """Keys of phrases of this size that grow from the first words and may occur often enough.

    ``known`` has those of each smaller size. Equal keys are counted together, so no phrase
    that occurs often enough is missing; a row is two numbers, whatever the words are.
    """

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64)), "n": pa.array(counts)})

    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in _read_slices(batches):
            wanted = np.append(False, first.holds(part.keys[1:]))
            at = np.flatnonzero(wanted[part.ids])
            key = part.keys[part.ids[at]]
            for j in range(1, size):
                word = part.ids[at + j]
                goes_on = word > 0
                if j > 1:
                    goes_on &= known[j].holds(key)
                at, key, word = at[goes_on], key[goes_on], word[goes_on]
                key = _longer(key, part.keys[word])
            held.append(key)
            if sum(map(len, held)) > HELD_KEYS:
                yield counted(held)
                held = []
        if held:
            yield counted(held)

    partial = corpus.mapInArrow(grow, "key bigint, n bigint")
    return partial.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST).select("key")


def measured(corpus: DataFrame, wanted: Mapping[int, Bitmap]) -> DataFrame:
    """Columns lang, phrase, n and inside of the phrases in the bitmaps, by their sizes.

    ``inside``: all occurrences stand between the same two words on one side, so a longer
    phrase occurs as often. There may be other phrases in the result too.
    """

    def same(neighbours: np.ndarray, starts: np.ndarray) -> np.ndarray:
        low, high = (f.reduceat(neighbours, starts) for f in (np.minimum, np.maximum))
        return np.where(low == high, low, 0)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _read_slices(batches):
            at = np.flatnonzero(part.ids)
            key = part.keys[part.ids[at]]
            for size in range(2, max(wanted) + 1):
                word = part.ids[at + size - 1]
                at, key, word = at[word > 0], key[word > 0], word[word > 0]
                key = _longer(key, part.keys[word])
                hit = wanted[size].holds(key) if size in wanted else np.zeros(len(at), dtype=bool)
                hits, starts = part.grouped(at[hit], size)
                if len(hits):
                    sides = [same(part.ids[hits - 1], starts), same(part.ids[hits + size], starts)]
                    left, right = (part.words.take(pa.array(s)).cast(pa.string()) for s in sides)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([part.lang] * len(starts), pa.string()),
                            "phrase": part.phrases(hits[starts], size),
                            "n": pa.array(np.diff(np.append(starts, len(hits)))),
                            "left": left,
                            "right": right,
                        }
                    )

    partial = corpus.mapInArrow(measure, "lang string, phrase string, n bigint, left string, right string")

    def one(side: str) -> Column:
        return (F.count(side) == F.count(F.lit(1))) & (F.min(side) == F.max(side))

    return partial.groupBy("lang", "phrase").agg(
        F.sum("n").alias("n"), (one("left") | one("right")).alias("inside")
    )


def _size() -> Column:
    return F.size(F.split("phrase", " "))


def _of_words(words: DataFrame) -> DataFrame:
    return words.select(F.xxhash64("lang", "phrase").alias("key"))


def _scored(found: DataFrame, known: DataFrame, totals: DataFrame) -> DataFrame:
    """Columns lang, phrase, a, l, r, n and score of phrases that no longer one replaces."""
    words = F.split("phrase", " ")
    cuts = found.withColumn("size", F.size(words)).withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    )
    cuts = cuts.select(
        "lang",
        "phrase",
        F.col("n").alias("a"),
        "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        counts = known.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
        cuts = cuts.join(counts, ["lang", part])
    a, n, left, right = (F.col(c).cast("decimal(20,0)") for c in ("a", "n", "l", "r"))
    # Decimals multiply exactly to 38 digits; ``div`` cuts off and gives a long.
    scored = cuts.join(totals, "lang").withColumns(
        {"_above": a * n * F.lit(1000).cast("decimal(4,0)"), "_below": left * right}
    )
    scored = scored.withColumn("score", F.expr("_above div _below"))
    best = F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("_best")
    lowest = scored.groupBy("lang", "phrase").agg(best)
    # What would replace one of the longest phrases is too long to be a phrase.
    inside = known.where(F.col("inside") & (_size() < LONGEST)).select("lang", "phrase")
    return lowest.join(inside, ["lang", "phrase"], "left_anti").select("lang", "phrase", "_best.*").drop("k")


def _best(rows: DataFrame, best: int) -> DataFrame:
    """The first of each language with their rank, in rounds of parts of bounded size."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    n = rows.count()
    while n > max(TASK_ROWS, 4 * best):
        part = F.pmod(F.xxhash64("phrase", F.lit(n)), F.lit(-(-n // max(TASK_ROWS, 4 * best))))
        ranked = rows.withColumn("_part", part).withColumn(
            "rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
        )
        rows = stage(ranked.where(F.col("rank") <= best).drop("_part", "rank"))
        less = rows.count()
        if less > 0.9 * n:  # as many languages as that: each is small
            break
        n = less
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= best)


def collocations(docs: DataFrame, best: int = BEST) -> DataFrame:
    """The first ``best`` phrases of every language by score: lang, rank, phrase and counts.

    Reads ``text`` and ``lang`` only. A null text is empty, a null language ``und``. Words
    are lower-cased in A-Z; phrases do not cross ``.,;:!?`` or line breaks. A phrase has
    2 to 5 words and occurs ``LEAST`` times at least; one whose every occurrence lies in the
    same longer phrase is left out. Ties of score go by count, then by the phrase's bytes.
    Repeated rows count as often as they stand there. Without such phrases, and for an empty
    table, the result is empty.
    """
    with small_batches(docs.sparkSession):
        return _collocations(docs, best)


def _collocations(docs: DataFrame, best: int) -> DataFrame:
    texts = docs.select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    counts = stage(word_counts(texts))
    totals = stage(counts.groupBy("lang").agg(F.sum("n").alias("n")))
    often = counts.where(F.col("n") >= LEAST)
    words = stage(often.select("lang", F.col("word").alias("phrase"), "n", F.lit(False).alias("inside")))
    corpus = stage(skeleton(texts, Bitmap.of(_of_words(words))))
    above = (F.col("total").cast("decimal(20,0)") * F.lit(1000).cast("decimal(4,0)")).alias("_above")
    frontier = words.join(totals.withColumnRenamed("n", "total"), "lang").select("lang", "phrase", "n", above)
    frontier = frontier.withColumn("bound", F.expr("_above div n")).drop("_above")
    settled = survivors = None
    reach = FIRST_REACH * LEAST
    while True:
        if survivors is not None:
            # A language with enough phrases needs no word whose bound is below its last one.
            last = settled.where(F.col("rank") == best).select("lang", F.col("score").alias("needed"))
            frontier = frontier.drop("needed").join(last, "lang", "left")
            frontier = stage(frontier.where("needed IS NULL OR bound >= needed"))
        else:
            frontier = stage(frontier.withColumn("needed", F.lit(None).cast("bigint")))
        if frontier.isEmpty():
            break
        now = F.col("needed").isNotNull() | (F.col("n") <= reach)
        found = _round(corpus, frontier.where(now).select("lang", "phrase"), words, totals)
        frontier = frontier.where(~now)
        reach *= REACH_STEP
        if found is not None:
            merged = found if settled is None else settled.drop("rank").unionByName(found)
            survivors = settled = stage(_best(merged, best))
    if settled is None:
        empty = words.limit(0)
        settled = _scored(empty, words, totals).withColumn("rank", F.lit(1))
    numbers = ["rank", "a", "l", "r", "n", "score"]
    return settled.select("lang", "phrase", *[F.col(c).cast("bigint").alias(c) for c in numbers])


def _round(corpus: DataFrame, first: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame | None:
    """Scored phrases that grow from these words; None if there are no such phrases."""
    if first.isEmpty():
        return None
    start, known = Bitmap.of(_of_words(first)), {}
    for size in range(2, LONGEST + 1):
        level = stage(grown(corpus, start, known, size))
        if level.isEmpty():
            break
        known[size] = Bitmap.of(level)
    if not known:
        return None
    chosen = first.select("lang", F.col("phrase").alias("_first"))
    counted = measured(corpus, known).where(F.col("n") >= LEAST)
    counted = counted.withColumn("_first", F.substring_index("phrase", " ", 1))
    found = stage(counted.join(chosen, ["lang", "_first"], "left_semi").drop("_first"))
    parts = rest = found
    for _ in range(LONGEST - 2):  # what remains behind a cut
        rest = rest.where(_size() > 2).select(
            "lang", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("phrase")
        )
        parts = rest if parts is found else parts.unionByName(rest)
    parts = parts.where(_size() > 1).distinct().join(found, ["lang", "phrase"], "left_anti")
    parts = stage(with_keys(parts).withColumn("size", _size()))
    wanted = {size: Bitmap.of(parts.where(F.col("size") == size)) for size in range(2, LONGEST)}
    others = measured(corpus, wanted).join(parts.select("lang", "phrase"), ["lang", "phrase"], "left_semi")
    return stage(_scored(found, stage(words.unionByName(found).unionByName(others)), totals))
