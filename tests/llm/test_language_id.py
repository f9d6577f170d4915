import math
import zlib
from collections import Counter

import numpy as np
import pytest
from arrears.llm import language_id as li
from arrears.llm.catalog import op4_language_id
from pyspark.sql import functions as F

from .conftest import by_id


def test_held_out_accuracy_on_the_whole_table(spark, table):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in table("documents", folder).collect()}
    found = by_id(op4_language_id(spark, folder))
    assert found.keys() == lang.keys()
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
    apart = [r for r in found.values() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in apart) >= 0.98 * len(apart)


def test_held_out_labels_do_not_matter(table):
    docs = table("documents")
    wrong = docs.withColumn("lang", F.when(li.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    row = lambda df: sorted((r.doc_id, r.lang_pred, r.score) for r in li.identified(df).collect())
    assert row(docs) == row(wrong.withColumn("source", F.lit("other")))


def test_nulls_no_letters_long_and_empty(spark, frame, table):
    model = li.fit(table("documents"))
    texts = [None, "", "123 !? \n", "le la les une des qui que dans " * 5000, "漢字", "\U00020000"]
    found = by_id(li.predict(frame(texts, lang_pred="x", score="y"), model))
    assert [found[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and found[0].score == 0
    assert found[3].lang_pred in model.labels and found[4].lang_pred in model.labels
    assert found[5].lang_pred in model.labels
    assert li.identified(frame([])).collect() == []


def test_nothing_to_learn_from_and_one_language(spark, frame):
    assert {r.lang_pred for r in li.identified(frame(["some text", "more"])).collect()} == {"und"}
    rows = [(i, f"text number {i}", "aa") for i in range(12)] + [(None, "no id", "aa")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = li.identified(df).collect()
    assert {r.lang_pred for r in found} == {"aa"} and all(abs(r.score - 1) < 1e-9 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [True]


def test_leader_finds_a_planted_signal_and_is_sparse():
    rng = np.random.default_rng(2)
    examples = []
    for i in range(900):
        label = i % 3
        noise = rng.choice(np.arange(10, 400), 12, replace=False)
        examples.append((np.r_[label, noise], np.r_[0.7, np.full(12, 0.2)], label))
    w = li.follow_the_leader(examples, 3, 400, l1=0.4)
    assert (w[:3].argmax(axis=1) == [0, 1, 2]).all()
    assert (w == 0).mean() > 0.3
    loose = li.follow_the_leader(examples, 3, 400, l1=0.0)
    assert (loose == 0).mean() < (w == 0).mean()


def test_temperature_restores_scaled_probabilities():
    rng = np.random.default_rng(4)
    logits = rng.normal(size=(4000, 3)) * 1.5
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    labels = np.array([rng.choice(3, p=q) for q in p])
    assert abs(li.fitted_temperature(logits * 4, labels) - 4) < 0.5
    assert li.fitted_temperature(np.zeros((0, 3)), np.zeros(0, dtype=int)) == 1.0


def brute_counts(text, buckets):
    """Hashed n-grams by plain numbers, one after the other."""
    line, before = [32], False
    for c in text.lower():
        if c.isalpha() or before:
            line.append(ord(c) if c.isalpha() else 32)
        before = c.isalpha()
    found = Counter()
    for start in range(len(line) + 1 if any(c.isalpha() for c in text.lower()) else 0):
        h, gram = 0, [*line, 32][start : start + 3]
        for order, code in enumerate(gram):
            h = (h * 0x100000001B3 + code + order) % 2**64
            found[((h ^ h >> 29) * 0xBF58476D1CE4E5B9 % 2**64 >> 40) % buckets] += 1
    return found


@pytest.mark.parametrize("piece", [500_000, 7])
def test_counts_and_predictions_match_brute_force(monkeypatch, piece):
    monkeypatch.setattr(li, "PIECE", piece)
    rng = np.random.default_rng(6)
    buckets, labels = 64, ["a", "b", "c"]
    texts = ["", "a", "?", "Ab, c!!", "", "x" * 40, "1 2 3", "é É  ü.", "the end ", "漢 字\n\n"]
    texts += ["".join(rng.choice(list("aB c.?é"), rng.integers(0, 30))) for _ in range(60)]
    text, at, counts = li.ngram_counts(texts, li.Letters(), buckets)
    found = [Counter() for _ in texts]
    for i, b, n in zip(text.tolist(), at.tolist(), counts.tolist(), strict=True):
        assert b not in found[i]
        found[i][b] = n
    assert found == [brute_counts(t, buckets) for t in texts]
    weights = rng.normal(size=(buckets, 3)) * (rng.random((buckets, 1)) < 0.5)
    model = li.Model(labels, rng.random(buckets), weights, 0.3)
    names, scores = model.predict(texts, li.Letters())
    for t, name, score in zip(texts, names, scores, strict=True):
        own = {b: n * model.idf[b] for b, n in brute_counts(t, buckets).items()}
        norm = math.sqrt(sum(x * x for x in own.values())) or 1.0
        e = [math.exp(sum(x * weights[b, k] for b, x in own.items()) / norm / 0.3) for k in range(3)]
        expected = (labels[e.index(max(e))], max(e) / sum(e)) if own else ("und", 0.0)
        assert name == expected[0] and abs(score - expected[1]) < 1e-9


def test_leader_matches_the_formulas_one_number_at_a_time():
    rng = np.random.default_rng(8)
    examples = [(rng.choice(20, 4, replace=False), rng.normal(size=4), int(rng.integers(3))) for _ in range(50)]
    z, n = ({(b, k): 0.0 for b in range(20) for k in range(3)} for _ in range(2))

    def weight(c):
        if abs(z[c]) <= 0.05:
            return 0.0
        return (math.copysign(0.05, z[c]) - z[c]) / ((1.0 + math.sqrt(n[c])) / 0.5 + 0.5)

    for _ in range(2):
        for at, x, label in examples:
            w = {(b, k): weight((b, k)) for b in at.tolist() for k in range(3)}
            e = [math.exp(sum(v * w[b, k] for b, v in zip(at.tolist(), x, strict=True))) for k in range(3)]
            for b, v in zip(at.tolist(), x, strict=True):
                for k in range(3):
                    g = v * (e[k] / sum(e) - (k == label))
                    z[b, k] += g - (math.sqrt(n[b, k] + g * g) - math.sqrt(n[b, k])) / 0.5 * w[b, k]
                    n[b, k] += g * g
    found = li.follow_the_leader(examples, 3, 20, epochs=2, alpha=0.5, beta=1.0, l1=0.05, l2=0.5)
    assert all(abs(found[c] - weight(c)) < 1e-12 for c in z)


def test_too_many_languages_are_refused(spark):
    rows = [(i, "some text", f"l{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError, match="more than 8"):
        li.fit(df, max_languages=8)
    assert len(li.fit(df, max_languages=9).labels) == 9
