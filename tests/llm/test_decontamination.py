import random
import re
import subprocess
import sys
from hashlib import sha256

import pytest
from arrears.llm import decontamination as d
from arrears.llm.catalog import op7_decontamination

from .conftest import by_id

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, window=13):
    grams = {}
    for item, text in items:
        own = words(text)
        width = min(window, len(own))
        for k in range(len(own) - width + 1 if own else 0):
            grams.setdefault(tuple(own[k : k + width]), set()).add("" if item is None else str(item))
    found = {}
    for i, text in docs:
        own, hit, of = words(text), set(), set()
        for k in range(len(own)):
            for width in {len(g) for g in grams}:
                if names := grams.get(tuple(own[k : k + width])) if k + width <= len(own) else None:
                    hit.update(range(k, k + width))
                    of |= names
        found[i] = (len(own), len(hit), sorted(of), len(hit) > 0 and 20 * len(hit) >= len(own))
    return found


def result(df):
    return {
        r.doc_id: (r.n_words, r.n_hit, sorted({m.item_id for m in r.matches}), r.contaminated) for r in df.collect()
    }


@pytest.mark.parametrize("window,block", [(4, 10**6), (4, 60), (1, 10**6), (3, 25)])
def test_random_words_match_brute_force(spark, frame, window, block):
    rng = random.Random(window)
    text = lambda n: " ".join(rng.choice("abcdeF") for _ in range(n))
    docs = [(i, text(rng.randint(0, 80))) for i in range(40)]
    items = [(i, text(rng.randint(0, 9))) for i in range(25)]
    items += [(90, items[3][1]), (91, docs[5][1])]
    found = d.contamination(frame(docs, n_hit="x"), spark.createDataFrame(items, ITEMS), window, block)
    assert result(found) == brute_force(docs, items, window)


def test_longest_match_and_its_places(spark, frame):
    passage = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(1, f"x y {passage} z")], ITEMS)
    docs = frame([f"head {passage} tail", "w0 w1 w2", f"W3, {passage.upper()}"])
    found = by_id(d.contamination(docs, items))
    assert [tuple(m) for m in found[0].matches] == [("1", 30, 1, 2)] and found[0].spans == [1, 31]
    assert found[1].matches == [] and not found[1].contaminated
    assert [tuple(m) for m in found[2].matches] == [("1", 30, 1, 2)]


def test_nulls_empties_and_clashing_columns(spark, frame):
    long = "clean words only " * 20_000
    items = [(1, None), (2, ""), (3, "..."), (None, "one two three"), (4, "é ü")]
    docs = [(0, None), (1, ""), (2, "ONE two, three"), (2, "ONE two, three"), (None, "É ü"), (5, long + "one two three")]
    df = frame(docs, _spans="a", _n_words="b", _matches="c")
    kept = d.decontaminated(df, spark.createDataFrame(items, ITEMS))
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r["_spans"]) for r in kept.collect()) == [
        (False, 0, "a"), (False, 1, "a"), (False, 5, "a"), (True, 0, "a"),
    ]  # É is not a letter that is lowered, so "É ü" is another word
    none = spark.createDataFrame([], ITEMS)
    assert d.decontaminated(df, none).count() == len(docs)
    assert d.contamination(frame([]), none).collect() == []


def test_query_on_the_whole_table(spark, table):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table("documents").collect()]
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    expected = brute_force(docs, items)
    found = by_id(op7_decontamination(spark, folder))
    assert any(e[3] for e in expected.values())
    for i, (n, hit, names, bad) in expected.items():
        digest = sha256(",".join(names).encode()).hexdigest()
        r = found[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(names), digest, bad)


@pytest.mark.parametrize("item", [7, None])
def test_blocks_stay_small_when_rows_share_an_item_id(spark, frame, monkeypatch, item):
    sizes = []
    broadcast = type(spark.sparkContext).broadcast

    def recorded(context, rows):
        sizes.append(sum(len(text) for _, text in rows))
        return broadcast(context, rows)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", recorded)
    items = [(item, " ".join(f"t{i}w{k}" for k in range(20))) for i in range(40)] + [(item, "again and again")] * 500
    docs = [(0, f"a {items[3][1]} b"), (1, items[17][1]), (2, "nothing of it"), (3, "again and again")]
    found = result(d.contamination(frame(docs), spark.createDataFrame(items, ITEMS), 13, 1_000))
    assert sum(sizes) < 6_000 and max(sizes) < 2_500
    found = {i: (n, hit, sorted(set(of)), bad) for i, (n, hit, of, bad) in found.items()}
    assert found == brute_force(docs, items)


def brute_longest(text, item):
    """Words of the longest common run, by the plain table of common endings."""
    own, other, best = words(text), words(item), 0
    row = [0] * (len(other) + 1)
    for w in own:
        row = [0] + [row[k] + 1 if w == x else 0 for k, x in enumerate(other)]
        best = max(best, *row)
    return best


@pytest.mark.parametrize("expanded,lookups", [(10**6, 65_536), (1, 3)])
def test_longest_matches_of_random_words_match_brute_force(monkeypatch, expanded, lookups):
    monkeypatch.setattr(d, "EXPANDED", expanded)
    monkeypatch.setattr(d, "LOOKUPS", lookups)
    rng = random.Random(expanded)
    for letters in ("a", "ab", "abcde"):
        text = lambda n, of=letters: " ".join(rng.choice(of + "?") for _ in range(n))
        docs = [text(rng.randint(0, 40)) for _ in range(20)]
        items = [(str(i), text(rng.randint(0, 25))) for i in range(12)] + [("x", docs[3]), ("y", "zz"), ("z", "")]
        match = d.Match(d.TestSet(items, 4), docs)
        tests = d.TestSet(items, 4)
        for i, doc in enumerate(docs):
            expected = {}
            for name, item in items:
                best, width = brute_longest(doc, item) if words(item) else 0, min(4, len(words(item)))
                if words(item) and best >= width:
                    expected[name] = best
            found = {tests.items[k]: (n, at, item_at) for k, n, at, item_at in match.longest.get(i, [])}
            assert {k: v[0] for k, v in found.items()} == expected
            of = dict(items)
            for name, (n, at, item_at) in found.items():
                assert words(doc)[at : at + n] == words(of[name])[item_at : item_at + n]


MEASURED = """
import resource, sys
from arrears.llm import decontamination as d
def peak():
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
"""


def run_alone(code):
    """Runs the code in a process of its own, whose peak memory (MB) it prints last."""
    done = subprocess.run([sys.executable, "-c", MEASURED + code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    return [int(x) for x in done.stdout.split()]


def test_one_word_repeated_takes_little_memory():
    """100,000 equal words in a document and in an item, which have 10 billion common places."""
    hit, words_matched, peak = run_alone(
        "text = 'word ' * 100_000\n"
        "m = d.Match(d.TestSet([('1', text)], 13), [text, 'word ' * 12])\n"
        "print(int(m.hit.sum()), m.longest[0][0][1], peak())\n"
        "assert list(m.longest) == [0]"
    )
    assert (hit, words_matched) == (100_000, 100_000) and peak < 600


def test_a_whole_block_takes_bounded_memory():
    """A block of the default size, of random words, as a worker holds it."""
    n, peak = run_alone(
        "import random\n"
        "rng = random.Random(5)\n"
        "words = [f'{rng.getrandbits(40):x}'[:rng.randint(2, 8)] for _ in range(100_000)]\n"
        "items = [(str(i), ' '.join(rng.choices(words, k=100))) for i in range(d.BLOCK_BYTES // 600)]\n"
        "t = d.TestSet(items, 13)\n"
        "m = d.Match(t, [items[i][1] for i in range(0, 5000)])\n"
        "assert all(m.longest[i][0][:2] == (i, 100) for i in range(5000))\n"
        "print(len(t.grams), peak())"
    )
    assert n > 1_000_000 and peak < 1000
