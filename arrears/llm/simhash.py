"""Near-duplicates by SimHash fingerprints, joined on a grid of per-segment bit counts.

A fingerprint's 64 bits are 32 segments of two; its embedding holds the number of set bits
of each. The Manhattan distance of two embeddings is never more than the Hamming distance of
the fingerprints. With the bits of every segment sorted, the embedding is again a 64-bit
word (counts 0, 1, 2 as 00, 01, 11) and the Manhattan distance is the number of bits in
which two such words differ.

The segments form ``groups`` groups. Two embeddings within ``limit`` agree fully in at least
``groups - limit`` of them, so the grid has one cell per choice of that many groups and their
counts: whoever is in range shares a cell. Inside a cell the Manhattan bound is tested first
and the Hamming distance afterwards, which decides.

More groups give a fingerprint more cells but put far fewer strangers into each: with a
limit of 3, five groups have 10 cells of some 18 random bits, seven have 35 of 27 and eight
have 56 of 30.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.batches import parts_by_text
from arrears.llm.components import star_components
from arrears.sources.staging import stage

SHINGLE_WORDS, SEED, LIMIT = 3, 42, 3
GROUPS = 8
LOW_BITS = 0x5555555555555555  # the lower bit of each segment
SPLIT = 20_000  # fingerprints of a cell that one task compares; a larger cell is split
HASHES = 65_536  # shingles of a text that are hashed at once
FEW = 8  # cells up to this size are compared together, row against row


def simhash(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned fingerprint: a bit is set if more than half the shingle hashes set it.

    Words are runs of characters other than blanks and the controls 9 to 13, with A-Z in
    lower case. Fewer words than a shingle: one shingle of them all. No word: zero.
    """
    from xxhash import xxh64_digest

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle_words, len(words))
    n = len(words) - width + 1
    starts, ends = starts[:n], ends[width - 1 :]
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, HASHES):
        spans = zip(starts[i : i + HASHES].tolist(), ends[i : i + HASHES].tolist(), strict=True)
        digests = b"".join([xxh64_digest(joined[a:b], seed) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprinted(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, a hash of the text, and the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts_by_text(batches, "text"):
            found = np.array([simhash(t, shingle_words) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("text_hash"), pa.array(found.view(np.int64))],
                names=["doc_id", "text_hash", "fp"],
            )

    own = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return own.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def _embedded(fp: Column) -> Column:
    """The fingerprint with the two bits of every segment sorted."""
    low = F.lit(LOW_BITS)
    shifted = F.shiftrightunsigned(fp, 1)
    any_bit = fp.bitwiseOR(shifted).bitwiseAND(low)
    both_bits = fp.bitwiseAND(shifted).bitwiseAND(low)
    return any_bit.bitwiseOR(F.shiftleft(both_bits, 1))


def _embedded_words(fp: np.ndarray) -> np.ndarray:
    low, one = np.uint64(LOW_BITS), np.uint64(1)
    shifted = fp >> one
    return ((fp | shifted) & low) | ((fp & shifted & low) << one)


def cell_masks(limit: int, groups: int = GROUPS) -> list[int]:
    """Bit masks of every choice of ``groups - limit`` groups of segments, as signed longs."""
    if not limit < groups <= 32:
        raise ValueError(f"there must be more than {limit} groups, and at most 32: {groups}")
    limits = [round(i * 32 / groups) for i in range(groups + 1)]
    bits = [
        sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(limits, limits[1:], strict=False)
    ]
    masks = [sum(chosen) for chosen in combinations(bits, groups - limit)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _near(a: np.ndarray, b: np.ndarray | np.uint64, limit: int) -> np.ndarray:
    """Which fingerprints are in range: the Manhattan bound, then the exact distance."""
    bound = np.bitwise_count(_embedded_words(a) ^ _embedded_words(b)) <= limit
    return bound & (np.bitwise_count(a ^ b) <= limit)


def _tree(fps: np.ndarray, limit: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join whatever is linked among the fingerprints, without all pairs.

    Each fingerprint is compared with those not reached yet only, so a dense cell costs
    little more than its size.
    """
    left, links = fps, []
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = _near(left, x, limit)
            if near.any():
                hits, left = left[near], left[~near]
                links.append((np.full(len(hits), x), hits))
                reached.extend(hits)
    return links


def _cell_links(limit: int, groups: int):
    """A function over rows sorted by cell that yields the links found inside the cells.

    Two fingerprints may share many cells. In a small cell their link is given only if it is
    the first that they share; larger cells give links that join whatever is near in them.
    """
    masks = np.array(cell_masks(limit, groups), dtype=np.int64).view(np.uint64)

    def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        difference = _embedded_words(a) ^ _embedded_words(b)
        return ((difference[:, None] & masks) == 0).argmax(axis=1)

    def found(cells: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(fps)])
        group = np.repeat(np.arange(len(starts)), sizes)
        few = np.repeat(sizes <= FEW, sizes)
        links = []
        for step in range(1, min(FEW, len(fps))):
            pair = np.flatnonzero((group[step:] == group[:-step]) & few[step:])
            a, b = fps[pair], fps[pair + step]
            near = np.flatnonzero(_near(a, b, limit) & (a != b))
            near = near[first_shared(a[near], b[near]) == cells[pair[near], 0]]
            links.append((a[near], b[near]))
        for i in np.flatnonzero(sizes > FEW):
            links += _tree(np.unique(fps[starts[i] : starts[i] + sizes[i]]), limit)
        a, b = (np.concatenate([x[k] for x in links]) if links else fps[:0] for k in (0, 1))
        if not len(a):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_cells = np.zeros((0, 4), dtype=np.int64)
        held_fps = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(c).to_numpy().astype(np.int64) for c in ("mask", "cell", "i", "j")]
            cells = np.concatenate([held_cells, np.stack(own, axis=1)])
            fps = np.concatenate([held_fps, batch.column("fp").to_numpy().view(np.uint64)])
            last = len(fps) - 1  # the last cell may go on in the next batch
            same = (cells == cells[last]).all(axis=1)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut and (links := found(cells[:cut], fps[:cut])):
                yield links
            held_cells, held_fps = cells[cut:], fps[cut:]
        if len(held_fps) and (links := found(held_cells, held_fps)):
            yield links

    return run


def _large_cells(cells: DataFrame, rows: int, split: int) -> DataFrame:
    """Cells with more than ``split`` fingerprints, and into how many parts they go.

    Nearly every cell is small, so buckets of about a quarter of ``split`` rows are counted
    first, which tasks add up before the shuffle; only cells in too large ones are counted.
    """
    buckets = max(1, -(-4 * rows // split))
    bucketed = cells.withColumn("bucket", F.pmod(F.xxhash64("mask", "cell"), F.lit(buckets)))
    suspects = stage(
        bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split).select("bucket")
    )
    return stage(
        bucketed.join(suspects, "bucket", "left_semi")
        .groupBy("mask", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > split)
        .select("mask", "cell", F.ceil(F.col("n") / split).cast("int").alias("parts"))
    )


def fingerprint_links(
    fps: DataFrame, limit: int = LIMIT, split: int = SPLIT, groups: int = GROUPS
) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints of ``fps`` (column ``fp``).

    They join whatever is linked by distances up to ``limit``; inside a cell a spanning
    tree is enough, so a dense cell gives fewer links than pairs. A cell with more than
    ``split`` fingerprints is cut into parts, and every two parts are compared in a task of
    their own. ``groups`` (more than ``limit``) sets how fine the grid is, not the result.
    """
    embedding = _embedded(F.col("fp"))
    masks = cell_masks(limit, groups)
    masked = F.array(*[embedding.bitwiseAND(F.lit(m)) for m in masks])
    cells = fps.select("fp", F.posexplode(masked).alias("mask", "cell"))
    large = _large_cells(cells, fps.count() * len(masks), split)
    dealt = cells.withColumns({"i": F.lit(0), "j": F.lit(0)})
    if not large.isEmpty():
        sized = cells.join(large, ["mask", "cell"], "left")
        part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != F.col("part"))
        split_rows = (
            sized.where("parts IS NOT NULL")
            .withColumn("part", part)
            .withColumn("other", F.explode(others))
            .select(
                "fp", "mask", "cell",
                F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
            )
        )
        small = sized.where("parts IS NULL").select("fp", "mask", "cell", F.lit(0).alias("i"), F.lit(0).alias("j"))
        dealt = small.unionByName(split_rows)
    keys = ["mask", "cell", "i", "j"]
    return (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys)
        .select(*keys, "fp")
        .mapInArrow(_cell_links(limit, groups), "a bigint, b bigint")
    )


def _grouped(docs: DataFrame, shingle_words: int, limit: int, split: int, groups: int) -> DataFrame:
    """doc_id, text_hash, fp and component_id of every document."""
    rows = stage(fingerprinted(docs, shingle_words))
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    stars = star_components(fingerprint_links(classes.select("fp"), limit, split, groups))
    members = stage(stars.withColumnRenamed("node", "fp").join(classes, "fp"))
    least = members.groupBy("root").agg(F.min("first_id").alias("least_id"))
    linked = members.join(least, "root").select("fp", "least_id")
    of_class = classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("least_id", "first_id").alias("component_id")
    )
    return rows.join(of_class, "fp")


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    limit: int = LIMIT,
    split: int = SPLIT,
    groups: int = GROUPS,
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document.

    Two documents are linked if their fingerprints differ in at most ``limit`` bits;
    component_id is the smallest doc_id that links reach, the own one included. Reads
    ``doc_id`` and ``text`` only. A null or empty text has no words and fingerprint zero,
    which is linked like any other. Repeated rows give repeated results; null ids are left
    out of the smallest id, so component_id is null where a component has no other.

    Equal fingerprints collapse to one row before the join, so a group of copies costs one.
    """
    return _grouped(docs, shingle_words, limit, split, groups).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    limit: int = LIMIT,
    split: int = SPLIT,
    groups: int = GROUPS,
) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, all columns kept.

    Rows with equal doc_id and text stay or go together; of rows that share a doc_id but not
    the text, each is judged by its own text. Rows without an id stay only where no row of
    their component has one.
    """
    found = _grouped(docs, shingle_words, limit, split, groups)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keys = kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")).distinct()
    return docs.join(
        keys,
        docs["doc_id"].eqNullSafe(keys["_kept_id"]) & (F.xxhash64(docs["text"]) == keys["_kept_hash"]),
        "left_semi",
    )
