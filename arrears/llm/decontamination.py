"""Benchmark passages in documents, found with suffix arrays over shards of documents.

A task cuts its documents into shards. The words of a shard become numbers (words that no
benchmark item has: 0, which matches nothing), and its suffixes are sorted by their first
``window`` words: the shard's suffix array. Each benchmark suffix is looked up by binary
search; the suffixes that begin with its first ``window`` words are all places where that
window occurs. Windows that follow each other on one diagonal are one longer match.

Such a match begins where the words before differ and ends where the words behind differ.
Only these two ends are listed: the places of a window are kept in the order of the word
before and of the word behind, so those that merely go on are passed over as one range. A
text and an item that repeat one word therefore cost their lengths, not the product.

Suffixes whose first two words follow each other in no item cannot match more than one
word; they are left out of the array before it is sorted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.batches import fresh, parts_by_text, spans_by_size
from arrears.sources.staging import stage

WINDOW = 13
SHARE = 20  # contaminated: hit words times this are at least all words
BLOCK_BYTES = 8_000_000  # benchmark text that a Python worker holds
SHARD_BYTES = 4_000_000
PASSES = 4  # blocks looked up in one stage, each by a worker of its own; then the state is written
LOOKUPS = 65_536  # windows looked up at once
EXPANDED = 1_000_000  # ends of matches listed at once, or those of one document

# Digits, letters and everything beyond ASCII are word characters; A-Z become a-z.
_WORD_BYTES = bytes(
    b if chr(b).isascii() and (chr(b).isdigit() or chr(b).islower()) or b > 127
    else b + 32 if 65 <= b <= 90
    else 32
    for b in range(256)
)


def words(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


class TestSet:
    """The windows of a block of benchmark items, as sorted rows. Build it inside a task."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[str] = []
        listed = []
        for item, text in items:
            own = words(text)
            if own:
                self.items.append(item)
                known = self.vocabulary
                listed.append(np.array([known.setdefault(w, len(known) + 1) for w in own], dtype=np.int32))
        lengths = np.array([len(x) for x in listed], dtype=np.int64)
        # One zero before each item, and enough of them behind the last one.
        begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] + 1
        numbers = np.zeros(int((lengths + 1).sum()) + window + 1, dtype=np.int32)
        for begin, own in zip(begins, listed, strict=True):
            numbers[begin : begin + len(own)] = own
        widths = np.minimum(lengths, window)
        item_at, item = _expanded(np.zeros_like(lengths), lengths - widths + 1)
        at, width = begins[item] + item_at, widths[item]
        rows = numbers[at[:, None] + np.arange(window)]
        rows[np.arange(window) >= width[:, None]] = 0
        order = np.lexsort(rows.T[::-1]) if len(rows) else at
        rows = rows[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        self.grams, self.widths = rows[new], width[order][new]
        self.starts = np.append(np.flatnonzero(new), len(rows))
        gram = np.zeros(len(rows), dtype=np.int64)
        gram[order] = np.cumsum(new) - 1
        self.before = self._places(gram, numbers[at - 1], item, item_at)
        self.behind = self._places(gram, numbers[at + width], item, item_at)
        first, second = self.grams[:, 0], self.grams[:, 1] if window > 1 else 0 * self.grams[:, 0]
        self.single = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        self.single[first[self.widths == 1]] = True
        self.hashes = self._hashed(first, second)
        self.pairs = np.zeros(1 << 22, dtype=bool)  # hashed; may let through a few others
        self.pairs[self.hashes] = True

    def _places(self, gram, beside, item, item_at) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All windows by gram and neighbouring word: that key, the item and the place in it."""
        key = gram * (len(self.vocabulary) + 1) + beside
        order = np.argsort(key, kind="stable")
        return key[order], item[order].astype(np.int32), item_at[order].astype(np.int32)

    def ends(self, side: tuple, gram: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges of the places of each gram that have another neighbouring word, or none.

        Begins and ends of the ranges, and the row of ``gram`` that each belongs to.
        """
        keys = side[0]
        first, last = self.starts[gram], self.starts[gram + 1]
        key = gram * (len(self.vocabulary) + 1) + beside
        known = beside > 0
        left = np.where(known, np.searchsorted(keys, key, side="left"), last)
        right = np.where(known, np.searchsorted(keys, key, side="right"), last)
        row = np.arange(len(gram))
        return np.concatenate([first, right]), np.concatenate([left, last]), np.concatenate([row, row])

    def _hashed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.int64) * 1_000_003 + b) & ((1 << 22) - 1)

    def candidates(self, numbers: np.ndarray) -> np.ndarray:
        """Places whose suffix may begin a window."""
        after = np.append(numbers[1:], 0)
        begins = self.pairs[self._hashed(numbers, after)] & (after > 0)
        return np.flatnonzero((numbers > 0) & (begins | self.single[numbers]))

    def possible(self, numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Grams whose first two words (or only word) may follow each other at the places."""
        seen = np.zeros(1 << 22, dtype=bool)
        after = np.append(numbers[1:], 0)[places]
        seen[self._hashed(numbers[places], after)] = True
        seen[self._hashed(numbers[places], 0 * after)] = True  # windows of one word
        return np.flatnonzero(seen[self.hashes])


def _suffix_array(numbers: np.ndarray, window: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their next ``window`` words, and those words in that order."""
    padded = np.concatenate([numbers, np.zeros(window, dtype=numbers.dtype)])
    heads = padded[at[:, None] + np.arange(window)]
    order = np.lexsort(heads.T[::-1]) if len(at) else at
    return at[order], heads[order]


def _bounds(heads: np.ndarray, grams: np.ndarray, widths: np.ndarray, after: bool) -> np.ndarray:
    """By binary search, where each gram's range of suffixes begins (or ends, if ``after``)."""
    found = [np.zeros(0, dtype=np.int64)]
    for i in range(0, len(grams), LOOKUPS):
        own, rows = grams[i : i + LOOKUPS], np.arange(len(grams[i : i + LOOKUPS]))
        low = np.zeros(len(own), dtype=np.int64)
        high = np.full(len(own), len(heads), dtype=np.int64)
        beyond = np.arange(heads.shape[1])[None, :] >= widths[i : i + LOOKUPS, None]
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high) // 2, 0)
            difference = heads[middle] - own
            difference[beyond] = 0
            first = (difference != 0).argmax(axis=1)
            sign = difference[rows, first]
            right = (sign < 0) | (after & (sign == 0))
            low = np.where(open_ & right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        found.append(low)
    return np.concatenate(found)


def _expanded(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range that each comes from."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(starts, sizes) + within, owner


class Match:
    """What a shard's documents share with the test set."""

    def __init__(self, tests: TestSet, texts: list[str]) -> None:
        listed = [words(t) for t in texts]
        self.counts = np.array([len(w) for w in listed], dtype=np.int64)
        # One zero behind each document, so no match runs on into the next.
        self.begins = np.concatenate([[0], np.cumsum(self.counts + 1)])
        numbers = np.zeros(self.begins[-1], dtype=np.int32)
        get = tests.vocabulary.get
        for start, own in zip(self.begins, listed, strict=False):
            numbers[start : start + len(own)] = list(map(get, own, repeat(0)))
        candidates = tests.candidates(numbers)
        sought = tests.possible(numbers, candidates)
        places, heads = _suffix_array(numbers, tests.window, candidates)
        left = _bounds(heads, tests.grams[sought], tests.widths[sought], False)
        right = _bounds(heads, tests.grams[sought], tests.widths[sought], True)
        # A place begins one window of each width at most.
        rank, row = _expanded(left, right)
        at, gram = places[rank], sought[row]
        width = tests.widths[gram]
        change = np.bincount(at, minlength=len(numbers) + 1) - np.bincount(
            at + width, minlength=len(numbers) + 1
        )
        self.hit = np.cumsum(change[: len(numbers)]) > 0
        self.longest: dict[int, list[tuple[int, int, int, int]]] = {}
        order = np.argsort(at, kind="stable")
        at, gram, width = at[order], gram[order], width[order]
        doc = np.searchsorted(self.begins, at, side="right") - 1
        around = np.concatenate([[0], numbers, [0]])
        starts = tests.ends(tests.before, gram, around[at])
        stops = tests.ends(tests.behind, gram, around[at + width + 1])
        sizes = np.bincount(starts[2], starts[1] - starts[0], minlength=len(at))
        for a, b in self._parts(doc, sizes):
            self._add_longest(tests, doc, at, width, starts, stops, a, b)

    def _parts(self, doc: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of windows with whole documents and about ``EXPANDED`` ends of matches."""
        firsts = np.append(np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]][: len(doc)]), len(doc))
        totals = np.add.reduceat(sizes, firsts[:-1]).tolist() if len(doc) else []
        for a, b in spans_by_size(totals, EXPANDED):
            yield int(firsts[a]), int(firsts[b])

    def _add_longest(self, tests, doc, at, width, starts, stops, a: int, b: int) -> None:
        """By document, for each item the longest match: item, words, places in both."""

        def listed(side: tuple, ends: tuple) -> tuple[np.ndarray, ...]:
            own = (ends[2] >= a) & (ends[2] < b)
            place, part = _expanded(ends[0][own], ends[1][own])
            row = ends[2][own][part]
            item, item_at = side[1][place], side[2][place]
            order = np.lexsort((at[row], at[row] - item_at, item, doc[row]))
            return row[order], item[order], item_at[order]

        # On a diagonal of a document and an item, beginnings and ends take turns.
        first, item, item_at = listed(tests.before, starts)
        last, _, _ = listed(tests.behind, stops)
        size = at[last] - at[first] + width[last]
        best = np.lexsort((at[first], -size, item, doc[first]))
        key = np.stack([doc[first][best], item[best]])
        new = np.ones(len(best), dtype=bool)
        new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        for i in best[new].tolist():
            number = int(doc[first[i]])
            self.longest.setdefault(number, []).append(
                (int(item[i]), int(size[i]), int(at[first[i]] - self.begins[number]), int(item_at[i]))
            )


MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.StringType()),
            T.StructField("n_words", T.IntegerType()),
            T.StructField("doc_word", T.IntegerType()),
            T.StructField("item_word", T.IntegerType()),
        ]
    )
)
_MATCHES_ARROW = pa.list_(
    pa.struct([("item_id", pa.string()), ("n_words", pa.int32()), ("doc_word", pa.int32()), ("item_word", pa.int32())])
)
def _spans(hit: np.ndarray) -> list[int]:
    """Begin and end of each run of hit words, one after the other."""
    return np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0])).tolist()


def _matched(
    docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int
) -> tuple[DataFrame, list[str]]:
    """``docs`` with three more columns, and their names: words, hit spans and matches.

    The benchmark goes to the tasks in blocks of about ``block_bytes``, each looked up in a
    pass over the documents as they stream by; ``PASSES`` of them follow each other in one
    stage. Blocks are dealt by id and text, repeated rows once, so neither an id nor a text
    that many rows share makes a block larger.
    """
    spark = docs.sparkSession
    # A null item_id is reported as the empty one.
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    items = stage(benchmark.select(item, F.coalesce("text", F.lit("")).alias("text")).distinct())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    own = list(docs.columns)
    added = [fresh(docs, n) for n in ("_n_words", "_spans", "_matches")]
    kinds = [pa.int64(), pa.list_(pa.int32()), _MATCHES_ARROW]
    types = [T.LongType(), T.ArrayType(T.IntegerType()), MATCHES]
    fields = [T.StructField(n, t) for n, t in zip(added, types, strict=True)]
    schema = T.StructType([*docs.schema.fields, *fields])
    found = docs
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        # About block_bytes of text.
        rows = [(r.item, r.text) for r in part.sort("item", "text").collect()]
        shared = spark.sparkContext.broadcast(rows)

        def run(
            batches: Iterable[pa.RecordBatch], shared=shared, again: bool = block > 0
        ) -> Iterator[pa.RecordBatch]:
            tests = TestSet(shared.value, window)
            for shard, texts in parts_by_text(batches, "text", SHARD_BYTES):
                match = Match(tests, texts)
                earlier = [shard.column(n).to_pylist() for n in added[1:]] if again else None
                spans, matches = [], []
                for i, (start, n) in enumerate(zip(match.begins, match.counts, strict=False)):
                    hit = match.hit[start : start + n]
                    listed = [
                        {"item_id": tests.items[k], "n_words": w, "doc_word": d, "item_word": at}
                        for k, w, d, at in match.longest.get(i, [])
                    ]
                    if again:
                        hit = hit.copy()
                        marks = earlier[0][i]
                        for a, b in zip(marks[::2], marks[1::2], strict=True):
                            hit[a:b] = True
                        listed = earlier[1][i] + listed
                    spans.append(_spans(hit))
                    matches.append(listed)
                new = zip((match.counts.tolist(), spans, matches), kinds, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [shard.column(n) for n in own] + [pa.array(x, k) for x, k in new],
                    names=[*own, *added],
                )

        if block and block % PASSES == 0:
            found = stage(found)
        found = found.mapInArrow(run, schema)
    return found, added


def _hits(spans: str) -> Column:
    begins = F.sequence(F.lit(1), F.size(spans), F.lit(2))
    sizes = F.transform(begins, lambda i: F.element_at(spans, i + 1) - F.element_at(spans, i))
    total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.when(F.size(spans) > 0, total).otherwise(F.lit(0).cast("bigint"))


def _is_contaminated(words: str, spans: str) -> Column:
    return (_hits(spans) > 0) & (_hits(spans) * SHARE >= F.col(words))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """What every document shares with the benchmark.

    Reads doc_id and text of ``docs``, item_id and text of ``benchmark``. A window is
    ``window`` consecutive words of an item, or all words of a shorter one. Returns doc_id,
    n_words, n_hit (words inside an occurrence of a window), spans (begin and end of each
    run of such words), matches (for each item its longest verbatim match: words, place in
    the document, place in the item), and contaminated (a twentieth of the words or more
    are hit). Null and empty texts have no words and are clean; items without words have no
    windows; items with equal words are all reported; an empty benchmark finds nothing.
    """
    own = docs.select("doc_id", "text")
    found, (words, spans, matches) = _matched(own, benchmark, window, block_bytes)
    return found.select(
        "doc_id",
        F.col(words).alias("n_words"),
        _hits(spans).alias("n_hit"),
        F.col(spans).alias("spans"),
        F.col(matches).alias("matches"),
        _is_contaminated(words, spans).alias("contaminated"),
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents that are not contaminated, with all their columns, row by row."""
    found, (words, spans, _) = _matched(docs, benchmark, window, block_bytes)
    return found.where(~_is_contaminated(words, spans)).select(*docs.columns)
