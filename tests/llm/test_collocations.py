import re
from collections import Counter

import numpy as np
import pytest
from arrears.llm import collocations as c
from arrears.llm.catalog import op11_collocations

DOCS = "doc_id bigint, text string, lang string, phrase string, n int"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_force(rows, least=100, best=2000):
    """Every phrase counted, every cut scored, every longer phrase compared."""
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 6):
                for k in range(len(words) - size + 1):
                    count[lang, tuple(words[k : k + size])] += 1
    often = {key: a for key, a in count.items() if len(key[1]) > 1 and a >= least}
    gone = set()
    for (lang, phrase), a in often.items():
        for size in range(2, len(phrase)):
            for k in range(len(phrase) - size + 1):
                part = phrase[k : k + size]
                if 100 * a >= 100 * count[lang, part]:
                    gone.add((lang, part))
    found = {}
    for (lang, phrase), a in often.items():
        if (lang, phrase) not in gone:
            cuts = []
            for k in range(1, len(phrase)):
                left, right = count[lang, phrase[:k]], count[lang, phrase[k:]]
                cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, right))
    return [
        (lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, rows in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:best], 1)
    ]


def result(df):
    return sorted(tuple(r[k] for k in COLUMNS) for r in df.collect())


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)], DOCS)


def test_query_on_the_whole_table(spark, table):
    rows = [(r.text, r.lang) for r in table("documents", "/root/testdata/sf0.01").collect()]
    found = result(op11_collocations(spark, "/root/testdata/sf0.01"))
    assert found and found == sorted(brute_force(rows))


def corpus(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" if i % 7 else f"W{i}É\xa0x" for i in range(40)]
    odd = 1 / (1 + np.arange(40))
    rows = []
    for i in range(150):
        words = rng.choice(vocabulary, size=int(rng.integers(0, 40)), p=odd / odd.sum())
        ends = rng.choice(list(" ") * 8 + [".", ", ", "\t", "\n", "\x0b", " ? ", "  ", "\r\n"], size=len(words))
        text = "".join(w + e for w, e in zip(words, ends, strict=True))
        rows.append((text, ["en", "en", None, "und", ""][i % 5]))
    rows += [("same words again and again and again " * 9, "en")] * 5 + [(None, "en"), ("", None), (" . ", "x")]
    rows += [("deep fixed phrase of five more", "y")] * 30 + [("of five", "y")] * 3
    return rows


@pytest.mark.parametrize("least,best,bits", [(4, 7, 24), (6, 3, 6), (20, 2000, 8)])
def test_random_texts(spark, monkeypatch, least, best, bits):
    """Ties, runs of one word, overlaps, all separators; few survivors wanted, full bitmaps."""
    monkeypatch.setattr(c, "LEAST", least)
    monkeypatch.setattr(c, "BITS", bits)
    monkeypatch.setattr(c, "FIRST_REACH", 2)
    monkeypatch.setattr(c, "REACH_STEP", 3)
    monkeypatch.setattr(c, "SLICE_BYTES", 3000)
    monkeypatch.setattr(c, "SKELETON_BYTES", 2000)
    monkeypatch.setattr(c, "HELD_KEYS", 50)
    monkeypatch.setattr(c, "TASK_ROWS", 10)
    rows = corpus(least * best)
    assert result(c.collocations(frame_of(spark, rows), best)) == sorted(brute_force(rows, least, best))


def test_the_frontier_is_cut_off(spark, monkeypatch):
    """Words whose bound cannot reach the best phrases are not grown."""
    monkeypatch.setattr(c, "LEAST", 10)
    grown_from = []
    plain = c._round

    def watched(corpus, first, *others):
        grown_from.append({r.phrase for r in first.collect()})
        return plain(corpus, first, *others)

    monkeypatch.setattr(c, "_round", watched)
    monkeypatch.setattr(c, "FIRST_REACH", 2)
    rows = [(" ".join(f"a{i} b{i} . the of ." for i in range(30)), "en")] * 12 + [("the of " * 500, "en")]
    assert result(c.collocations(frame_of(spark, rows), 5)) == sorted(brute_force(rows, 10, 5))
    assert {"the", "of"}.isdisjoint(set().union(*grown_from))


def test_tables_without_phrases(spark):
    assert result(c.collocations(frame_of(spark, []))) == []
    assert result(c.collocations(frame_of(spark, [(None, None), ("a b", "en")]))) == []


def test_large_products_are_exact(spark):
    big = 3 * 10**12
    found = spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, n bigint")
    known = spark.createDataFrame(
        [("en", "a", big + 7, False), ("en", "b", big + 1, False)],
        "lang string, phrase string, n bigint, inside boolean",
    )
    totals = spark.createDataFrame([("en", 10**15)], "lang string, n bigint")
    row = c._scored(found, known, totals).first()
    assert row.score == 1000 * big * 10**15 // ((big + 7) * (big + 1))
