import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from arrears.llm import mixing as m
from arrears.llm.catalog import op12_mixing
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, source string, shard string, rank int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected_targets(rows):
    """Shares by weight; whoever is above three times its size leaves with that."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, found = Fraction(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in found]
        above = [s for s in free if left * weight[s] / sum(weight[f] for f in free) > 3 * sizes[s]]
        if not above:
            break
        found.update({s: 3 * sizes[s] for s in above})
        left = sum(sizes.values()) - Fraction(sum(found.values()))
    free = [s for s in order if s not in found]
    return sizes, found | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}


def nearest(target):
    return int(target + Fraction(1, 2))


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)


def check(mix, rows):
    sizes, targets = expected_targets(rows)
    taken = mix.taken().collect()
    assert Counter((r.doc_id, r.size) for r in taken) == Counter((i, len(words(t))) for i, t, _ in rows)
    pieces = mix.pieces().collect()
    got, of_source = Counter(), Counter()
    for p in pieces:
        got[p.doc_id, p.key] += p.n_words
        of_source[p.source] += p.n_words
    assert Counter(of_source) == Counter({s: nearest(t) for s, t in targets.items() if nearest(t)})
    assert sum(r.taken for r in taken) == sum(of_source.values())
    assert all(0 <= r.taken <= 3 * r.size for r in taken)
    assert {(r.source_size, round(r.target, 6)) for r in taken} == {
        (sizes[s], round(float(targets[s]), 6)) for _, _, s in rows
    }
    return taken, pieces


def test_query_on_the_whole_table(spark, table):
    rows = [(r.doc_id, r.text, r.source) for r in table("documents").collect()]
    sizes, targets = expected_targets(rows)
    source = {i: s for i, _, s in rows}
    found = op12_mixing(spark, SMALL).collect()
    assert {(r.doc_id, r.size) for r in found} == {(i, len(words(t))) for i, t, _ in rows}
    total = Counter()
    for r in found:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(float(targets[source[r.doc_id]]))
        assert 0 <= r.taken <= 3 * r.size
        total[source[r.doc_id]] += r.taken
    assert total == Counter({s: nearest(t) for s, t in targets.items()})


def unclean(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        source = ["hot", "b", "é", "z", None, ""][min(int(rng.geometric(0.5)) - 1, 5)]
        text = " \n".join(f"w{i}x{k}" for k in range(int(rng.integers(0, 60))))
        rows.append((i, text, source))
    rows += [rows[0]] * 9 + [(None, rows[1][1], "hot")] * 3 + [(None, None, None), (7, None, "only-null")]
    rows += [(500, "long " * 5000, "b"), (501, "one", "tiny"), (7, "  \x1c", "tiny")]
    return rows


@pytest.mark.parametrize("slices,chunk", [(20_000, 10_000), (5, 4)])
def test_unclean_rows_are_mixed_exactly(spark, monkeypatch, slices, chunk):
    """Nulls, repeated rows and ids, hot and tiny sources, long texts; large and small slices."""
    monkeypatch.setattr(m, "SLICE_ROWS", slices)
    monkeypatch.setattr(m, "CHUNK", chunk)
    monkeypatch.setattr(m, "FINEST", 64)
    rows = unclean(spark)
    docs = table_of(spark, rows)
    mix = m.mix_documents(docs, shards=5)
    taken, pieces = check(mix, rows)

    # Every word is taken as often as its document's pieces say, in no pass twice.
    size = {(r.doc_id, r.key): r["size"] for r in mix.documents.collect()}
    copies = Counter((r.doc_id, r.key) for r in mix.documents.collect())
    marks = defaultdict(Counter)
    for p in pieces:
        assert p.first_word + p.n_words <= size[p.doc_id, p.key]
        for k in range(p.first_word, p.first_word + p.n_words):
            marks[p.doc_id, p.key, p["repeat"]][k] += 1
    for (doc, key, _), times in marks.items():
        assert max(times.values()) <= copies[doc, key]

    # Shards hold the same number of blocks, numbered without gaps.
    blocks = mix.draws.collect()
    held = Counter(r.shard for r in blocks)
    assert max(held.values()) - min(held.values()) <= 1
    for shard, n in held.items():
        assert sorted(r.place for r in blocks if r.shard == shard) == list(range(n))
    assert len({(r["rank"], r.block, r["repeat"]) for r in blocks}) == len(blocks)

    # The texts are the words of the documents.
    texts = {(i, k): t for i, k, t in docs.select("doc_id", m._key("document", F.col("doc_id"), F.col("text")), "text").collect()}
    by_place = {(p.shard, p.place, p.offset): p for p in pieces}
    for r in m.piece_texts(mix.pieces(), docs).collect():
        p = by_place[r.shard, r.place, r.offset]
        assert r.text.split(" ") == words(texts[p.doc_id, p.key])[p.first_word : p.first_word + p.n_words]


def test_reruns_agree_however_rows_are_split(spark):
    rows = unclean(spark)

    def run(docs):
        return sorted(map(repr, m.mix_documents(docs, shards=4).pieces().collect()))

    assert run(table_of(spark, rows)) == run(table_of(spark, rows[::-1]).repartition(7))


def test_many_sources_are_dealt_by_groups(spark, monkeypatch):
    monkeypatch.setattr(m, "FANOUT", 4)
    rows = [(i, "a b c d " * (i % 9), f"s{i % 37:02d}") for i in range(200)]
    check(m.mix_documents(table_of(spark, rows), shards=8), rows)


def test_tables_without_words(spark):
    assert m.mix_documents(table_of(spark, [])).taken().collect() == []
    mix = m.mix_documents(table_of(spark, [(1, None, "a"), (2, " ", None)]))
    assert {(r.doc_id, r.target, r.taken) for r in mix.taken().collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
    assert mix.pieces().collect() == []


@pytest.mark.parametrize("good,total,draws", [(3, 10, 4), (40, 1000, 500), (70_000, 200_000, 90_000), (5, 5, 3)])
def test_draws_follow_the_hypergeometric_law(spark, good, total, draws):
    u = F.col("id") / 4000 + F.lit(1 / 8000)
    long = [F.lit(x).cast("bigint") for x in (good, total, draws)]
    found = [r[0] for r in spark.range(4000).select(m.hypergeometric(*long, u)).collect()]
    reference = np.random.default_rng(2).hypergeometric(good, total - good, draws, 200_000)
    assert found == sorted(found)
    assert np.mean(found) == pytest.approx(draws * good / total, rel=1e-3)
    for share in (0.01, 0.25, 0.5, 0.75, 0.99):
        assert abs(np.quantile(found, share) - np.quantile(reference, share)) <= max(1, 0.02 * reference.std())
