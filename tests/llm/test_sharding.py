import random
import zlib

import pytest
from arrears.llm.sharding import DIGEST_DIGITS, minimax_cuts, shard_documents
from hashlib import sha256

from .conftest import by_id


def digest(text):
    return sha256((text or "").encode()).hexdigest()[:DIGEST_DIGITS]


def brute_force(texts, shards):
    """Capacity and shard of each text, by trying every capacity in turn."""
    groups = {}
    for t in texts:
        groups[digest(t)] = groups.get(digest(t), 0) + len((t or "").encode()) + 1
    order = sorted(groups)

    def greedy(capacity):
        placed, shard, held = {}, 0, 0
        for d in order:
            if groups[d] > capacity:
                return None
            if held + groups[d] > capacity:
                shard, held = shard + 1, 0
            held += groups[d]
            placed[d] = shard
        return placed if shard < shards else None

    capacity = -(-sum(groups.values()) // shards)
    while greedy(capacity) is None:
        capacity += 1
    return capacity, greedy(capacity)


def check(df, texts, shards):
    capacity, placed = brute_force(texts.values(), shards)
    found = df.collect()
    assert len(found) == len(texts)
    sizes = {}
    for r in found:
        text = texts[r.doc_id] or ""
        assert r.size == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
        assert r.shard == placed[digest(text)] and r.law == "bytes" and r.grown_shard is None
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
    assert max(sizes.values()) <= capacity
    for shard in sizes:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_random_groups_match_brute_force(frame, shards):
    rng = random.Random(shards)
    pool = ["x" * rng.randint(0, 90) + str(rng.random()) for _ in range(60)]
    texts = {i: rng.choice(pool) for i in range(300)}
    check(shard_documents(frame(list(texts.items())), shards), texts, shards)


def test_one_group_with_a_third_of_the_rows(frame):
    texts = {i: "copy" * 20 if i % 3 == 0 else f"text {i}" for i in range(400)}
    check(shard_documents(frame(list(texts.items())), 5), texts, 5)


def test_nulls_empties_long_texts_and_clashing_columns(frame):
    texts = {0: None, 1: "", 2: "é" * 50_000, 3: "a", 4: "a"}
    rows = frame(list(texts.items()), digest="d", shard="s", size="z", _group="g")
    check(shard_documents(rows, 4), texts, 4)


def test_fewer_groups_than_shards_and_none(frame):
    check(shard_documents(frame(["a", "a", "b"]), 16), {0: "a", 1: "a", 2: "b"}, 16)
    assert shard_documents(frame([]), 16).collect() == []


def test_null_and_repeated_ids_get_slots_of_their_own(frame):
    found = shard_documents(frame([(None, "a"), (None, "a"), (7, "a"), (7, "a")]), 2).collect()
    assert sorted(r.slot for r in found) == [0, 1, 2, 3] and len({r.shard for r in found}) == 1


def test_blocks_that_share_their_first_digits_are_cut_exactly(spark):
    rows = [(f"{'ab' * 5}{i:030x}", i % 7 + 1) for i in range(64)]
    df = spark.createDataFrame(rows, "digest string, size bigint")
    capacity, begins = minimax_cuts(df, 4)
    assert begins == sorted(begins) and len(begins) == 3
    held = [0] * 4
    for d, size in rows:
        held[sum(d >= b for b in begins)] += size
    assert max(held) == capacity


def test_query(spark):
    from arrears.llm.catalog import op1_sharding

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check(op1_sharding(spark, folder), {i: r.text for i, r in by_id(docs).items()}, 16)


def test_no_shard_is_refused(frame):
    with pytest.raises(ValueError):
        shard_documents(frame(["a"]), 0)
