from hashlib import sha256

import numpy as np
from arrears.llm import fingerprints as fp
from arrears.llm.catalog import op5_fingerprints


def edited(text, after):
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def check(rows, found):
    """rows: (doc_id, text) in their order."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        own, changed, following = fp.vectors([text, edited(text, after), after])
        expected.append((
            -1 if doc_id is None else doc_id, len(text), sha256(edited(text, after).encode()).hexdigest(),
            fp.written(own), fp.written(changed),
            round(float(fp.likeness(own[None], changed[None])[0]), 9),
            round(float(fp.likeness(own[None], following[None])[0]), 9),
        ))
    got = [
        (-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
         round(r.near_edited, 9), round(r.near_next, 9))
        for r in found
    ]
    assert sorted(got) == sorted(expected)


def test_query_on_the_whole_table(spark, table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    found = op5_fingerprints(spark, "/root/testdata/sf0.001").collect()
    check(rows, found)
    assert np.mean([r.near_edited for r in found]) > 0.6 > 0.3 > np.mean([r.near_next for r in found])


def test_many_buckets(frame, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 3)
    rows = [(i * i - 40, f"line {i}\n" * (i % 5) + "end" * i) for i in range(50)]
    check(rows, fp.fingerprints(frame(rows)).collect())


def test_nulls_empties_one_row_and_clashes(frame):
    rows = [(None, "no id"), (3, None), (5, ""), (9, "é🙂" * 40_000), (5, "same id"), (5, "same id")]
    check(rows, fp.fingerprints(frame(rows, _bucket="b", _guard="g", fingerprint="f")).collect())
    check([(1, "alone")], fp.fingerprints(frame([(1, "alone")])).collect())
    assert fp.fingerprints(frame([])).collect() == []


def test_order_of_paragraphs_does_not_count_and_updates_are_exact():
    a, b = "one two three", "four five six seven"
    both = fp.written(fp.vectors([f"{a}\n{b}"])[0])
    assert both == fp.written(fp.vectors([f"{b}\n\n{a}"])[0])
    assert both == fp.inserted(fp.written(fp.vectors([a])[0]), b)
    assert fp.deleted(both, b) == fp.written(fp.vectors([a])[0])
    assert fp.deleted(fp.deleted(both, b), a) == fp.written(fp.vectors([""])[0])


def test_slices_do_not_change_a_long_text(monkeypatch):
    text = "some words, repeated and varied 12 345\n" * 300
    whole = fp.vectors([text, "x"])
    monkeypatch.setattr(fp, "SLICE", 1000)
    assert (fp.vectors([text, "x"]) == whole).all()
