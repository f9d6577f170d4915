"""Repeated passages, found by shared rare lines, aligned, and deleted from the later document.

Words are runs of characters other than blanks and the controls 9 to 13. A line ends with a
line break or with a word that ends a sentence, and a sentence of more than
``2 * CUT_WORDS - 2`` words is cut again at words that its content chooses: the word with the
smallest hash of every ``CUT_WORDS`` in a row. Two documents that share a passage share its
cuts but for that many words at either edge, wherever they enter it.

Single lines are short and often stock, so they are taken together until they are rare: an
anchor is a run of whole lines that just reaches ``ANCHOR_WORDS`` words, forwards from a line
or backwards to one. Each anchor has a first holder, the document with the smallest (doc_id,
digest). A later document is aligned with the first holder of each of its anchors: as many
pairs as there are repeats, never all pairs of a group. Patience sorting puts the anchors of
a pair into chains that ascend in both documents; anchors of a chain that overlap or touch
on one diagonal are a block, and a block of ``MIN_WORDS`` words or more goes.

With both limits equal, as by default, every run of whole lines of that many words that
stands in one earlier document goes, whoever else holds parts of it, and nothing else does:
what goes stands, ``MIN_WORDS`` words in a row, in one earlier document. A shared passage of
``MIN_WORDS + 2 * (2 * CUT_WORDS - 2)`` words or more always holds such a run; what may stay
of it are ``2 * CUT_WORDS - 2`` words at an edge that lies inside a sentence.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.batches import fresh, parts_by_text
from arrears.sources.staging import stage

MIN_WORDS = 25  # a block of fewer words stays, so that stock lines do
ANCHOR_WORDS = MIN_WORDS
CUT_WORDS = 8  # a sentence is cut at the word with the smallest hash of so many

BLANKS = " \t\n\x0b\x0c\r"
BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2^64
HASHED = 1 << 20  # bytes that are hashed at once


class Words(NamedTuple):
    """Words of several texts, in the bytes of all of them one after the other."""

    data: bytes
    text_starts: np.ndarray  # byte at which each text begins, and one past the last
    starts: np.ndarray
    ends: np.ndarray
    first_words: np.ndarray  # first word of each text, and one past the last
    breaks: np.ndarray  # whether a sentence or a line of the text begins with the word


class Lines(NamedTuple):
    """Lines of several texts, as ranges of their words."""

    hashes: np.ndarray  # of the words
    first_words: np.ndarray
    line_starts: np.ndarray  # first word of each line
    line_ends: np.ndarray
    line_texts: np.ndarray  # the text a line belongs to


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.ones(n, dtype=np.uint64)
    known = 1
    while known < n:  # those known, times the next one
        step = np.uint64(pow(base, known, 1 << 64))
        more = min(known, n - known)
        np.multiply(powers[:more], step, out=powers[known : known + more])
        known += more
    return powers


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    hashes = np.empty(len(starts), dtype=np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + HASHED)))
        begin, end = int(starts[a]), int(ends[b - 1])
        values = data[begin:end].astype(np.uint64) + np.uint64(1)
        hashes[a:b] = _range_hashes(values, starts[a:b] - begin, ends[a:b] - begin)
        a = b
    return _mixed(hashes)


def _range_hashes(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomials in BASE of the values ``first`` up to ``end``, from running sums."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(BASE, len(values)), out=sums[1:])
    return (sums[end] - sums[first]) * _powers(pow(BASE, -1, 1 << 64), len(sums))[first]


def _cut_words(hashes: np.ndarray, sentences: np.ndarray) -> np.ndarray:
    """The words at which sentences that are too long are cut, some of them repeatedly."""
    long = np.bincount(sentences)[sentences] > 2 * CUT_WORDS - 2
    if len(hashes) < CUT_WORDS or not long.any():
        return np.zeros(0, dtype=np.int64)
    begins = np.flatnonzero((sentences[: 1 - CUT_WORDS] == sentences[CUT_WORDS - 1 :]) & long[: 1 - CUT_WORDS])
    windows = np.lib.stride_tricks.sliding_window_view(hashes, CUT_WORDS)[begins]
    return begins + windows.argmin(axis=1)


def words_of(texts: list[str]) -> Words:
    encoded = [t.encode() for t in texts]
    joined = b"\n".join([*encoded, b""])  # a line break parts the texts
    text_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in encoded])]).astype(np.int64)
    data = np.frombuffer(joined, dtype=np.uint8)
    blank = np.concatenate([[True], (data == 32) | ((data >= 9) & (data <= 13))])
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    ends = np.flatnonzero(~blank[:-1] & blank[1:])
    first_words = np.searchsorted(starts, text_starts)
    breaks = np.zeros(len(starts) + 1, dtype=bool)
    breaks[0] = True
    breaks[np.searchsorted(starts, np.flatnonzero(data == 10))] = True
    # A word ends a sentence if one of .!? stands behind its last letter or digit.
    mark = (data == 33) | (data == 46) | (data == 63)
    low = data | 32
    letter = (data >= 128) | ((data >= 48) & (data <= 57)) | ((low >= 97) & (low <= 122)) | (data == 95)
    breaks[1:] |= mark[ends - 1]
    open_words = np.flatnonzero(~(mark | letter)[ends - 1])  # end with another character
    deciding = np.flatnonzero(mark | letter)
    if len(deciding) and len(open_words):
        last = deciding[np.searchsorted(deciding, ends[open_words]) - 1]
        closed = mark[last] & (last >= starts[open_words]) & (last < ends[open_words])
        breaks[open_words[closed] + 1] = True
    breaks = breaks[:-1]
    return Words(joined, text_starts, starts, ends, first_words, breaks)


def lines_of(texts: list[str]) -> Lines:
    words = words_of(texts)
    hashes = _word_hashes(np.frombuffer(words.data, dtype=np.uint8), words.starts, words.ends)
    begins = words.breaks.copy()
    begins[_cut_words(hashes, np.cumsum(words.breaks) - 1)] = True
    line_starts = np.flatnonzero(begins)
    line_ends = np.append(line_starts[1:], len(begins)) if len(begins) else line_starts
    line_texts = np.searchsorted(words.first_words, line_starts, side="right") - 1
    return Lines(hashes, words.first_words, line_starts, line_ends, line_texts)


def anchors(lines: Lines, anchor_words: int = ANCHOR_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last line of every anchor, without repeats."""
    n = len(lines.line_starts)
    each = np.arange(n)
    # Forwards: up to the first line that ends so many words behind the begin.
    last = np.searchsorted(lines.line_ends, lines.line_starts + anchor_words)
    inside = np.append(lines.line_texts, -1)
    forward = inside[last] == lines.line_texts
    # Backwards: from the last line that begins so many words before the end.
    first = np.searchsorted(lines.line_starts, lines.line_ends - anchor_words, side="right") - 1
    backward = (first >= 0) & (lines.line_texts[first] == lines.line_texts)
    if n:
        backward &= last[first] != each  # else the two are the same run
    begins = np.concatenate([each[forward], first[backward]])
    ends = np.concatenate([last[forward], each[backward]]) + 1
    order = np.lexsort((ends, begins))
    return begins[order], ends[order]


def run_hashes(lines: Lines, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words ``first`` up to ``end``: equal words, whatever is between them."""
    return _mixed(_range_hashes(lines.hashes, first, end))


def patience_chains(places: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Aligned chains of matches (place here, place there): the longest in both orders first.

    Patience sorting finds the longest chain that ascends in both documents. What it leaves
    out has moved against it; each such match goes on with the chain that ends nearest below
    it, or begins one, so that every match is in a chain and a periodic text takes no longer.
    """
    places = sorted(places)
    if not places:
        return []
    tops: list[int] = []  # the smallest last place there of a chain of each length
    ends: list[int] = []
    before: list[int] = []
    for i, (_, there) in enumerate(places):
        pile = bisect_left(tops, there)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(there)
            ends.append(i)
        else:
            tops[pile], ends[pile] = there, i
    chain, i = [], ends[-1]
    while i >= 0:
        chain.append(i)
        i = before[i]
    chains = [[places[i] for i in reversed(chain)]]
    inside = set(chain)
    tops, rest = [], []  # minus the last place there of each chain of the rest, ascending
    for match in (m for i, m in enumerate(places) if i not in inside):
        pile = bisect_right(tops, -match[1])
        if pile == len(tops):
            tops.append(-match[1])
            rest.append([match])
        else:
            tops[pile] = -match[1]
            rest[pile].append(match)
    return chains + sorted(rest)


def common_blocks(matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Word ranges of a document that are aligned with another one's.

    A match is the range of an anchor here and its range there. Overlapping and adjacent
    anchors of a chain that lie on one diagonal are one block.
    """
    ends = {(a, c): b for a, b, c, _ in sorted(matches)}
    blocks = []
    for chain in patience_chains([(a, c) for a, _, c, _ in matches]):
        block = None
        for here, there in chain:
            end = ends[(here, there)]
            if block and here - there == block[2] and here <= block[1]:
                block[1] = max(block[1], end)
            else:
                block = [here, end, here - there]
                blocks.append(block)
    return [(b[0], b[1]) for b in blocks]


def covered_words(blocks: Iterable[tuple[int, int]]) -> list[list[int]]:
    """The union of word ranges, adjacent ones taken together."""
    runs: list[list[int]] = []
    for start, end in sorted(blocks):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return runs


KEY = ["doc_id", "uid"]


def _keyed(docs: DataFrame) -> DataFrame:
    """uid tells documents with one doc_id apart; rows equal in both are one document."""
    return docs.withColumn("uid", F.xxhash64("doc_id", "text"))


def _anchor_rows(docs: DataFrame, anchor_words: int, places: bool = True) -> DataFrame:
    """Every anchor of every document; without places only uid and anchor."""
    names = ["uid", "anchor", *(["doc_id", "word", "size"] if places else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts_by_text(batches, "text"):
            lines = lines_of(texts)
            begins, ends = anchors(lines, anchor_words)
            if not len(begins):
                continue
            owner = lines.line_texts[begins]
            first, end = lines.line_starts[begins], lines.line_ends[ends - 1]
            hashes = run_hashes(lines, first, end)
            rows = pa.array(owner)
            columns = [part.column("uid").take(rows), pa.array(hashes.view(np.int64))]
            if places:
                word = (first - lines.first_words[owner]).astype(np.int32)
                size = (end - first).astype(np.int32)
                columns += [part.column("doc_id").cast(pa.int64()).take(rows), pa.array(word), pa.array(size)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = {"uid": "bigint", "anchor": "bigint", "doc_id": "bigint", "word": "int", "size": "int"}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names)
    return docs.select("doc_id", "uid", "text").mapInArrow(run, schema)


SPANS = T.StructType(
    [
        T.StructField("_doc_id", T.LongType()),
        T.StructField("_uid", T.LongType()),
        T.StructField("_spans", T.ArrayType(T.IntegerType(), False)),
    ]
)


def _fragments(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Sorted matches, those that follow each other on one diagonal of a pair taken together."""
    *pair, word, word_end, first_word = batch.columns
    here, end, there = (c.to_numpy() for c in (word, word_end, first_word))
    diagonal = here - there
    parted = (diagonal[1:] != diagonal[:-1]) | (here[1:] > end[:-1])
    for column in pair:
        known = column.is_valid().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy()
        parted |= (values[1:] != values[:-1]) | (known[1:] != known[:-1])
    starts = np.flatnonzero(np.concatenate([[True], parted]))
    ends = np.maximum.reduceat(end, starts)
    rows = [c.take(pa.array(starts)).to_pylist() for c in pair]
    places = [here[starts], ends, there[starts], ends - diagonal[starts]]
    return zip(*rows, *(x.tolist() for x in places), strict=True)


def _aligner(min_words: int):
    """Word ranges that go per document, from matches sorted by document and first holder."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        later = holder = None
        matches: list[tuple[int, int, int, int]] = []
        blocks: list[tuple[int, int]] = []
        out: list[tuple] = []

        def close_pair() -> None:
            blocks.extend((a, b) for a, b in common_blocks(matches) if b - a >= min_words)
            matches.clear()

        def close_document() -> None:
            if blocks:
                out.append((*later, [x for span in covered_words(blocks) for x in span]))
            blocks.clear()

        def record() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=SPANS.names)

        for batch in filter(len, batches):
            for doc_id, uid, first, first_uid, *match in _fragments(batch):
                if later != (doc_id, uid) or holder != (first, first_uid):
                    close_pair()
                    if later != (doc_id, uid):
                        close_document()
                    later, holder = (doc_id, uid), (first, first_uid)
                matches.append(tuple(match))
            if len(out) > 2_000:
                yield record()
        close_pair()
        close_document()
        if out:
            yield record()

    return run


def repeated_words(docs: DataFrame, min_words: int = MIN_WORDS, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """``_doc_id``, ``_uid`` and ``_spans``: begin and end of each range of words that a
    document repeats from earlier ones, for documents that have any."""
    # Read twice, for the counts and for the occurrences: to split the lines again takes no
    # longer than to keep all anchors, and these are about as large as the texts.
    keyed = _keyed(docs.select("doc_id", "text"))
    held = _anchor_rows(keyed, anchor_words, places=False)
    # Whether two documents hold an anchor is decided on plain numbers, which aggregate
    # without sorting; the few that are shared go on with all their occurrences.
    several = held.groupBy("anchor").agg(F.min("uid").alias("u0"), F.max("uid").alias("u1"))
    shared = stage(several.where("u0 <> u1").select("anchor"))
    # The side without repeats is hashed, so that the rows need not be sorted.
    rows = _anchor_rows(keyed, anchor_words)
    rows = stage(rows.join(shared.hint("shuffle_hash"), "anchor"))
    # A struct with a null id is smaller than one with an id, so null ids count as earliest.
    holder = F.struct(F.col("doc_id").alias("d"), F.col("uid").alias("u"), F.col("word").alias("w"))
    holders = stage(rows.groupBy("anchor").agg(F.min(holder).alias("first")))
    first = F.col("first")
    matched = (
        rows.join(holders.hint("shuffle_hash"), "anchor")
        .where(~(F.col("doc_id").eqNullSafe(first["d"]) & (F.col("uid") == first["u"])))
        .select(
            "doc_id", "uid",
            first["d"].alias("first_id"), first["u"].alias("first_uid"),
            "word", (F.col("word") + F.col("size")).alias("word_end"), first["w"].alias("first_word"),
        )
    )
    return (
        matched.repartition(*KEY)
        .sortWithinPartitions("doc_id", "uid", "first_id", "first_uid", "word", "word_end", "first_word")
        .mapInArrow(_aligner(min_words), SPANS)
    )


def without_words(texts: list[str], spans: list[list[int]]) -> tuple[list[str], list[int], list[int]]:
    """The texts without ranges of words, how many lines of each went whole, and how many words.

    A word goes with the blanks behind it, the first one with those before it too. A text
    that loses its last word ends without blanks.
    """
    words = words_of(texts)
    found, lines_gone, words_gone = [], [], []
    sizes = np.diff(words.first_words)
    for i, own in enumerate(spans):
        first, n = int(words.first_words[i]), int(sizes[i])
        at, end = int(words.text_starts[i]), int(words.text_starts[i + 1]) - 1
        kept, whole, gone = [], 0, 0
        for a, b in zip(own[::2], own[1::2], strict=True):
            if a:
                kept.append(words.data[at : words.starts[first + a]])
            at = int(words.starts[first + b]) if b < n else end
            # Lines that begin in the range, but for a last one that goes on behind it.
            whole += int(np.count_nonzero(words.breaks[first + a : first + b]))
            whole -= b < n and not words.breaks[first + b] and bool(words.breaks[first + a : first + b].any())
            gone += b - a
        rest = b"".join([*kept, words.data[at:end]]).decode()
        found.append(rest.rstrip(BLANKS) if own[-1] == n else rest)
        lines_gone.append(whole)
        words_gone.append(gone)
    return found, lines_gone, words_gone


def without_repeated_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, anchor_words: int = ANCHOR_WORDS
) -> DataFrame:
    """``docs`` with repeated blocks deleted from ``text``, and two columns more.

    A block is a run of whole lines that one earlier document has too (smaller doc_id, at a
    tie smaller digest of id and text; null ids first), word by word, with ``min_words`` words
    or more in one chain of the alignment with it; blocks from several documents do not add
    up. An earlier document keeps its own. All other words, and all other columns, stay as
    they are. ``n_deleted_lines`` (sentences and lines that went whole) and
    ``n_deleted_words`` count what went (columns of those names are replaced). A document
    that loses all words gets the empty text. Null and empty texts stay. Rows equal in id
    and text are one document and get the same result; a repeat inside one document is not
    touched. Shorter anchors than ``min_words`` find the same blocks but for those whose
    parts have different first holders.
    """
    added = {"n_deleted_lines": T.LongType(), "n_deleted_words": T.LongType()}
    own = docs.drop(*added)
    spans = repeated_words(own, min_words, anchor_words)
    mark = fresh(own, "_spans")
    spans = spans.withColumnRenamed("_spans", mark)
    joined = own.join(
        spans,
        own["doc_id"].eqNullSafe(spans["_doc_id"])
        & (F.xxhash64(own["doc_id"], own["text"]) == spans["_uid"]),
        "left",
    ).select(*[own[c] for c in own.columns], spans[mark])
    names = list(own.columns)
    schema = T.StructType([*own.schema.fields, *(T.StructField(n, t) for n, t in added.items())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, hit = batch.column("text"), batch.column(mark).is_valid()
            lost = np.zeros((2, len(batch)), dtype=np.int64)
            at = np.flatnonzero(hit.to_numpy(zero_copy_only=False))
            changed = []
            for part, own in parts_by_text([batch.filter(hit)], "text"):
                done, *counts = without_words(own, part.column(mark).to_pylist())
                lost[:, at[len(changed) : len(changed) + len(done)]] = counts
                changed += done
            text = pc.replace_with_mask(text, hit, pa.array(changed, text.type))
            columns = [text if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, lost)], names=[*names, *added])

    return joined.mapInArrow(run, schema)
