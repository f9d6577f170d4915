import random
import re

import pytest
import xxhash
from arrears.llm import simhash as s
from arrears.llm.catalog import op10_simhash
from arrears.llm.components import star_components

from .conftest import by_id


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute_force(docs):
    prints = {i: brute_fingerprint(t) for i, t in docs}
    ids = sorted(prints)
    near = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = components(ids, near)
    return {i: (f"{prints[i]:016x}", roots[i]) for i in ids}


def result(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_query_on_the_whole_table(spark, table):
    docs = [(r.doc_id, r.text) for r in table("documents").collect()]
    assert result(op10_simhash(spark, "/root/testdata/sf0.001")) == brute_force(docs)


@pytest.mark.parametrize(
    "limit,split,few,groups",
    [(3, 20_000, 8, 8), (3, 16, 8, 8), (3, 20_000, 8, 7), (3, 16, 2, 5), (3, 8, 8, 4), (1, 20_000, 2, 8), (5, 40, 3, 7)],
)
def test_links_join_what_is_near(spark, monkeypatch, limit, split, few, groups):
    """Dense clusters, chains and strangers; cells split over tasks or not."""
    monkeypatch.setattr(s, "FEW", few)
    rng = random.Random(limit * split)
    prints = {0, 1, (1 << 64) - 1}
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            prints.add(x)
            for _ in range(rng.randint(1, limit + 1)):
                x ^= 1 << rng.randrange(64)
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = [(r.a, r.b) for r in s.fingerprint_links(df, limit, split, groups).collect()]
    mask = (1 << 64) - 1
    assert all(a != b and ((a ^ b) & mask).bit_count() <= limit for a, b in links)
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= limit]
    assert components(signed, links) == components(signed, near)


def test_embedding_bounds_the_distance():
    import numpy as np

    x = np.random.default_rng(1).integers(0, 1 << 63, 4000, dtype=np.uint64)
    y = np.roll(x, 1) ^ (np.uint64(1) << (x % np.uint64(64)))
    bound = np.bitwise_count(s._embedded_words(x) ^ s._embedded_words(y))
    assert (bound <= np.bitwise_count(x ^ y)).all()
    counts = [[int(v) >> 2 * i & 3 for i in range(32)] for v in x[:50]]
    sums = [[c.bit_count() for c in row] for row in counts]
    own = s._embedded_words(x[:50])
    assert [[(int(v) >> 2 * i & 3).bit_count() for i in range(32)] for v in own] == sums


def test_nulls_empties_copies_and_clashing_columns(frame):
    texts = [None, "", " \t", "A b", "a  B", "one two three four", "é É", "long " * 60_000, "long " * 60_000]
    df = frame(texts, fp="x", component_id="y", _kept_id="z")
    assert result(s.near_duplicates(df)) == brute_force(list(enumerate(texts)))
    kept = s.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 3, 5, 6, 7]
    assert s.near_duplicates(frame([])).collect() == []
    again = s.one_of_each(frame([(4, "same"), (4, "same"), (None, "same"), (9, "same")])).collect()
    assert [r.doc_id for r in again] == [4, 4]
    rows = [(5, "a"), (None, "a"), (None, "b"), (5, "c d"), (2, "c d")]
    assert sorted((r.doc_id or 0, r.text) for r in s.one_of_each(frame(rows)).collect()) == [
        (0, "b"), (2, "c d"), (5, "a"),
    ]


def test_few_strangers_share_a_cell():
    """Pairs in one cell among a million random fingerprints, from the bits of the embeddings."""
    import numpy as np

    fps = np.random.default_rng(4).integers(0, 1 << 63, 1_000_000, dtype=np.uint64) << np.uint64(1)
    words = s._embedded_words(fps)
    pairs = {}
    for groups in (5, 8):
        pairs[groups] = 0
        for mask in s.cell_masks(3, groups):
            sizes = np.unique(words & np.uint64(mask % (1 << 64)), return_counts=True)[1]
            pairs[groups] += int((sizes * (sizes - 1) // 2).sum())
    assert pairs[8] < 0.3 * len(fps) and pairs[5] > 50 * pairs[8]


def test_too_few_groups_are_refused():
    with pytest.raises(ValueError, match="more than 3 groups"):
        s.cell_masks(3, 3)


def test_components_of_chains_hubs_and_odd_links(spark):
    rng = random.Random(3)
    order = list(range(120))
    rng.shuffle(order)
    links = list(zip(order, order[1:], strict=False)) + [(500, i) for i in range(501, 560)]
    links += [(900, 901), (901, 900), (950, 950), (None, 3), (-5, 900)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.root for r in star_components(df).collect()}
    clean = [(a, b) for a, b in links if a is not None and a != b]
    expected = components({x for link in clean for x in link}, clean)
    assert found == expected
    assert star_components(df.where("a = 950")).collect() == []


def test_unlinked_documents_keep_their_own_id(frame):
    found = by_id(s.near_duplicates(frame([(5, "alpha beta gamma delta"), (2, "other words stand here now")])))
    assert {i: r.component_id for i, r in found.items()} == {5: 5, 2: 2}
