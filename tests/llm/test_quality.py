import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from arrears.llm import quality as q
from arrears.llm.catalog import op9_quality

from .conftest import by_id

LABELS = "doc_id bigint, quality int, toxic int"
TOKEN = re.compile(r"[0-9a-z_\x7f\x80-\U0010ffff]+|[!-/:-@\[-^`{-~]+")


def slow_tokens(text):
    return TOKEN.findall((text or "").lower())


def test_tokens_match_a_plain_split():
    texts = ["Ab cd!! ab", "", "é_1 ***x\ty\n\nab", "!!", "ab stemmed stemming stem"]
    h, stems, owner = q.Tokens()(texts)
    plain = [(i, t) for i, text in enumerate(texts) for t in slow_tokens(text)]
    assert owner.tolist() == [i for i, _ in plain]
    names = {}
    for value, (_, t) in zip(h.tolist(), plain, strict=True):
        assert names.setdefault(t, value) == value
    assert len(set(names.values())) == len(names)
    cut = {}
    for value, (_, t) in zip(stems.tolist(), plain, strict=True):
        assert cut.setdefault(t.encode()[: q.STEM], value) == value
    assert len(set(cut.values())) == len(cut) < len(names)


def test_passages_match_brute_force():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30))) for _ in range(40)]
    ratios = np.random.default_rng(1).normal(size=q.BUCKETS).astype(np.float32)
    found = q.lowest_passages(texts, ratios, q.Tokens())
    for i, text in enumerate(texts):
        single, pair = q.ngrams(*q.Tokens()([text]))
        v = [float(ratios[s]) + (float(ratios[p]) if p >= 0 else 0.0) for s, p in zip(single, pair, strict=True)]
        width = min(q.PASSAGE, len(v))
        low = min((sum(v[k : k + width]) for k in range(len(v) - width + 1)), default=0.0) if v else 0.0
        assert abs(found[i] - low) < 1e-4


def test_counts_over_tasks_match_a_plain_count(frame):
    texts = ["a b a", None, "b b!", "c " * 5000, ""]
    target, raw = q.count_ngrams(frame(texts).repartition(4), [0, 2, 99])
    for table, own in ((target, (0, 2)), (raw, range(5))):
        tokens = [slow_tokens(texts[i]) for i in own]
        assert table[: q.SINGLES].sum() == sum(map(len, tokens))
        assert table[q.SINGLES :].sum() == sum(max(0, len(t) - 1) for t in tokens)
    counted = Counter(t for text in texts for t in slow_tokens(text))
    assert sorted(c for c in raw[: q.SINGLES] if c) == sorted(counted.values())
    assert raw[q.REPEAT] == 1 + 4999  # pairs of equal tokens


def test_query_parts_good_from_bad(spark, table):
    folder = "/root/testdata/sf0.01"
    found = by_id(op9_quality(spark, folder))
    labels = {r.doc_id: (r.quality, r.toxic) for r in table("labels", folder).collect()}
    assert len(found) == table("documents", folder).count()
    good = [found[i].kept for i, x in labels.items() if x == (1, 0)]
    junk = [found[i].kept for i, x in labels.items() if x[0] == 0]
    assert np.mean(good) > 0.95 and np.mean(junk) < 0.1


def test_sampled_are_exactly_the_largest_keys(spark, table):
    rows = op9_quality(spark, "/root/testdata/sf0.001").collect()
    kept = sorted(r.key for r in rows if r.kept)
    assert all(r.key < kept[0] for r in rows if not r.kept)
    noise = [r.key - q.SHARPNESS * r.log_importance for r in rows]
    assert abs(np.mean(noise) - 0.5772) < 0.3 and abs(np.std(noise) - math.pi / math.sqrt(6)) < 0.3


@pytest.mark.parametrize("k", [1, 3, 50, 199, 200, 500])
def test_kth_largest(spark, k):
    rng = random.Random(k)
    values = [round(rng.gauss(0, 100), 3) for _ in range(190)] + [1e9, -1e9] + [5.0] * 8
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert q.kth_largest(df, "v", k) == sorted(values, reverse=True)[min(k, 200) - 1]
    assert q.kth_largest(df, "v", k, parts=3) == sorted(values, reverse=True)[min(k, 200) - 1]


def test_cut_weighs_good_documents_more():
    assert 0 < q.best_cut([1, 2, 3, 4], [-3, -2, -1]) <= 1 or q.best_cut([1, 2, 3, 4], [-3, -2, -1]) == 0
    assert q.best_cut([1, 2, 3], [2.5]) <= 1
    assert q.best_cut([], [1.0]) == q.best_cut([1.0], []) == float("-inf")


def test_nulls_no_labels_repeats_and_clashing_columns(spark, frame):
    docs = frame(
        [(None, "a b"), (1, None), (2, ""), (2, ""), (3, "word " * 50_000), (4, "a b c d e f")],
        log_importance="x", key="y", _importance="z", _id="w", quality="v",
    )
    none = spark.createDataFrame([], LABELS)
    assert all(r.kept for r in q.classify(docs, none).collect())
    odd = spark.createDataFrame([(1, None, None), (None, 1, 0), (4, 1, None), (4, 1, 0), (3, 0, None)], LABELS)
    kept = q.kept_documents(docs, odd)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in q.classify(docs, odd).collect())
    assert q.classify(frame([]), odd).collect() == [] and q.kept_documents(frame([]), none).collect() == []


def test_an_id_takes_its_worst_label(spark):
    rows = [(i, 1, 0) for i in range(50)] + [(7, 0, 0), (8, 1, 1)]
    sample = q.sampled_labels(spark.createDataFrame(rows, LABELS))
    assert not {7, 8} & set(sample.target + sample.held_good)
    assert len(sample.target) + len(sample.held_good) == 48 and len(sample.held_bad) <= 2
    assert len(q.sampled_labels(spark.createDataFrame(rows, LABELS), rows=10).target) < 30
