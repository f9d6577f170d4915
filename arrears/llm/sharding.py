"""Contiguous shards of nearly equal bytes that keep equal texts together.

Documents with equal texts are one atomic group. Groups are ordered by a digest of the
text, which is spread evenly, so a contiguous range of groups is a range of digests and no
sort of the corpus is needed. The capacity of the largest shard is the smallest one for
which a greedy walk over the ordered groups needs no more than the wanted shards; it is
found by binary search.

The walk never reads single groups of the whole corpus. It runs on sums over blocks of
groups (equal leading digits of the digest). A block is either one group, which cannot be
cut, or it hides where its groups end; taking such a block as freely divisible gives a
lower bound of the capacity and taking it as indivisible an upper bound. Only blocks near a
possible cut decide between the two, and they are summed again by more digits until both
bounds and all cuts agree. Then capacity and cuts are exact.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.sources.staging import stage

DIGEST_DIGITS = 40  # of SHA-256 in hexadecimal; equal digests are taken as equal texts
FIRST_DIGITS = 4  # the first blocks: 65,536 at most
MORE_DIGITS = 2  # each finer round cuts a block into 256 at most
BLOCKS_A_ROUND = 512  # blocks cut at once; the others wait for a later round
SLOT_GROUP = 20_000  # rows that are numbered together, about


@dataclass(frozen=True)
class Block:
    prefix: str
    size: int
    whole: bool  # one group, which cannot be cut


def _sums(rows: DataFrame, block: Column) -> list[Block]:
    summed = rows.groupBy(block.alias("block")).agg(
        F.sum("size").alias("size"), F.min("digest").alias("low"), F.max("digest").alias("high")
    )
    return [Block(r.block, r["size"], r.low == r.high) for r in summed.collect()]


def _starts(blocks: Sequence[Block]) -> list[int]:
    starts = [0]
    for block in blocks:
        starts.append(starts[-1] + block.size)
    return starts


Jump = Callable[[int, int], int]


def _jumps(blocks: Sequence[Block], starts: Sequence[int]) -> tuple[Jump, Jump]:
    """How far a shard that starts at a position reaches, at most and at least."""

    def furthest(position: int, capacity: int) -> int:
        end = position + capacity
        if end >= starts[-1]:
            return starts[-1]
        i = bisect_right(starts, end) - 1
        return starts[i] if blocks[i].whole else end

    def nearest(position: int, capacity: int) -> int:
        return starts[bisect_right(starts, position + capacity) - 1]

    return furthest, nearest


def _walk(jump: Jump, capacity: int, shards: int) -> list[int]:
    """The ends of the shards of a greedy walk."""
    ends, position = [], 0
    for _ in range(shards):
        position = jump(position, capacity)
        ends.append(position)
    return ends


def _smallest(jump: Jump, shards: int, total: int) -> int:
    low, high = -(-total // shards), total
    while low < high:
        middle = (low + high) // 2
        if _walk(jump, middle, shards)[-1] >= total:
            high = middle
        else:
            low = middle + 1
    return low


def minimax_cuts(rows: DataFrame, shards: int) -> tuple[int, list[str]]:
    """The smallest capacity, and the digest prefixes at which shards 1, 2, ... begin.

    ``rows`` has ``digest`` and ``size`` and is read a few times. A shard that stays empty
    begins past all digests. The driver holds block sums only, their number is bounded by
    the digits, not by the rows.
    """
    blocks = sorted(_sums(rows, F.substring("digest", 1, FIRST_DIGITS)), key=lambda b: b.prefix)
    while True:
        starts = _starts(blocks)
        total = starts[-1]
        furthest, nearest = _jumps(blocks, starts)
        low, high = _smallest(furthest, shards, total), _smallest(nearest, shards, total)
        least, most = _walk(nearest, low, shards), _walk(furthest, high, shards)
        if low == high and least == most:
            begins = {start: block.prefix for block, start in zip(blocks, starts, strict=False)}
            return low, [begins.get(end, "~") for end in least[:-1]]
        unsure: set[int] = set()
        for a, b in zip(least, most, strict=True):
            unsure.update(range(max(bisect_right(starts, a) - 1, 0), bisect_right(starts, b)))
        cut = sorted(
            (i for i in unsure if i < len(blocks) and not blocks[i].whole),
            key=lambda i: -blocks[i].size,
        )[:BLOCKS_A_ROUND]
        finer: list[Block] = []
        for digits in sorted({len(blocks[i].prefix) for i in cut}):
            chosen = [blocks[i].prefix for i in cut if len(blocks[i].prefix) == digits]
            within = rows.where(F.substring("digest", 1, digits).isin(chosen))
            finer += _sums(within, F.substring("digest", 1, digits + MORE_DIGITS))
        gone = set(cut)
        blocks = sorted(
            [b for i, b in enumerate(blocks) if i not in gone] + finer, key=lambda b: b.prefix
        )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Every document with its shard and a place in it.

    Reads ``doc_id`` and ``text`` only; other columns do not matter. Returns doc_id, size
    (UTF-8 bytes plus 1), text_crc32, law (``bytes``), shard, slot (0, 1, ... in each
    shard) and grown_shard, which this law leaves null. A null text counts as the empty
    one. Rows with equal texts share a shard, however many they are; repeated rows and null
    ids get slots of their own. With fewer groups than shards some shards stay empty; an
    empty table gives an empty result.

    Slots are numbered inside small hashed groups of a shard and shifted by what the
    earlier groups hold, so no task sorts a shard, however large one is.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = F.coalesce("text", F.lit(""))
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.substring(F.sha2(text, 256), 1, DIGEST_DIGITS).alias("digest"),
        )
    )
    n = rows.count()
    _, begins = minimax_cuts(rows, shards) if n else (0, [])
    shard = F.lit(0)
    for begin in begins:
        shard = shard + F.when(F.col("digest") >= begin, 1).otherwise(0)
    groups = max(16, -(-n // (shards * SLOT_GROUP)))
    placed = rows.withColumns(
        {
            "shard": shard.cast("int"),
            "_group": F.pmod(F.xxhash64("doc_id", "digest"), F.lit(groups)).cast("int"),
        }
    )
    earlier = Window.partitionBy("shard").orderBy("_group")
    offsets = placed.groupBy("shard", "_group").agg(F.count(F.lit(1)).alias("_rows")).select(
        "shard",
        "_group",
        (F.sum("_rows").over(earlier) - F.col("_rows")).alias("_before"),
    )
    inside = Window.partitionBy("shard", "_group").orderBy("doc_id", "digest")
    return (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(offsets, ["shard", "_group"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_before") + F.col("_place") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
