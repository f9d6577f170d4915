import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from arrears.llm import vector_codes as v
from arrears.llm.catalog import op13_vector_codes

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, parts=4, entries=256, rounds=4):
    """Plain loops over Python integers."""
    kept = []
    for i, x, label in rows:
        if x and all(c is not None and math.isfinite(c) for c in x):
            kept.append((i, [math.floor(c * 1024) for c in x], label))
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(order[0][1]) // parts
    cut = [slice(p * width, (p + 1) * width) for p in range(parts)]
    books = [[list(x[c]) for _, x, _ in order[:entries]] for c in cut]

    def nearest(book, part):
        scores = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in book]
        return min(range(len(book)), key=lambda k: (scores[k], k)), min(scores)

    for _ in range(rounds):
        for book, c in zip(books, cut, strict=True):
            members = defaultdict(list)
            for _, x, _ in kept:
                members[nearest(book, x[c])[0]].append(x[c])
            for k, found in members.items():
                book[k] = [sum(column) // len(found) for column in zip(*found, strict=True)]
    found, totals = [], defaultdict(int)
    for i, x, label in kept:
        best = [nearest(book, x[c]) for book, c in zip(books, cut, strict=True)]
        error = sum(e for _, e in best)
        totals[label] += error
        found.append((i, "".join(f"{k:02x}" for k, _ in best), error, label))
    numbers = ",".join(str(n) for book in books for entry in book for n in entry)
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return [(i, code, e, totals[label], digest) for i, code, e, label in found]


def result(df):
    return [(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=repr)


def test_query_on_the_whole_table(spark, table):
    rows = [tuple(r) for r in table("embeddings").select("vec_id", "embedding", "label").collect()]
    found = result(op13_vector_codes(spark, "/root/testdata/sf0.001"))
    assert ordered(found) == ordered(brute_force(rows))


@pytest.mark.parametrize("block", [7, 2048])
def test_unclean_rows(spark, monkeypatch, block):
    """Nulls, NaN, infinities, ties, repeated and null ids, null labels, empty vectors."""
    monkeypatch.setattr(v, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(c) for c in rng.integers(-3, 4, 8) / 8], i % 3 or None) for i in range(60)]
    rows += rows[:9] + [(5, rows[7][1], None), (None, rows[3][1], 1), (None, None, None)]
    for bad in (None, math.nan, math.inf, -math.inf):
        rows.append((1, [0.5, bad, *[0.25] * 6], 2))
    rows.append((0, [], 2))
    found = result(v.vector_codes(spark.createDataFrame(rows, VECTORS), entries=16))
    assert ordered(found) == ordered(brute_force(rows, entries=16))


def test_fewer_vectors_than_entries(spark):
    rows = [(3, [0.1] * 4, None), (2, [-0.1] * 4, None)]
    found = result(v.vector_codes(spark.createDataFrame(rows, VECTORS)))
    assert ordered(found) == ordered(brute_force(rows))
    assert {(i, code) for i, code, *_ in found} == {(2, "00" * 4), (3, "01" * 4)}


@pytest.mark.parametrize("size", [1e3, 1e6, 1e11])
def test_large_numbers_are_exact(spark, size):
    """Distances of 32, of 64 and of more bits."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * size).tolist(), 1) for i in range(40)]
    schema = VECTORS.replace("float", "double")
    found = result(v.vector_codes(spark.createDataFrame(rows, schema), entries=4))

    def fits(n):
        return n if n < 2**63 else None  # what 64 bits do not hold is null

    wanted = [(i, c, fits(e), fits(t), d) for i, c, e, t, d in brute_force(rows, entries=4)]
    codes = {(i, c, d) for i, c, *_, d in found}
    assert codes == {(i, c, d) for i, c, *_, d in wanted}
    if size < 1e11:  # a sum over rows of unknown errors is no number to compare
        assert ordered(found) == ordered(wanted)



def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert result(v.vector_codes(empty)) == []
    rows = [(i, [i / 7, i / 3, -i / 5, 1.0], i % 2) for i in range(9)]
    clashing = spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows], VECTORS + ", code string, error int, ids int"
    )
    assert ordered(result(v.vector_codes(clashing))) == ordered(brute_force(rows))


def test_several_lengths_are_an_error(spark):
    rows = [(1, [0.0] * 4, 1), (2, [0.0] * 8, 1)]
    with pytest.raises(ValueError):
        v.vector_codes(spark.createDataFrame(rows, VECTORS))
