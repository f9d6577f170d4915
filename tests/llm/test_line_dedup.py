import difflib
import itertools
import random
import re

from arrears.llm import line_dedup as ld
from arrears.llm.catalog import op3_line_dedup

from .conftest import by_id

P = [" ".join(f"p{i}w{k}" for k in range(20)) for i in range(6)]
ODD = "a stock line"


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def plain_hash(word):
    """The word hash, one byte at a time."""
    x = sum((c + 1) * pow(ld.BASE, k, 2**64) for k, c in enumerate(word.encode())) % 2**64
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
    return x ^ (x >> 31)


WORD = re.compile(r"[^ \t-\r]+[ \t-\r]*")


def plain_lines(text):
    """Lines as lists of words, each with the blanks behind it; begins of the text's own lines."""
    sentences = [[]]
    for word in WORD.findall(text):
        sentences[-1].append(word)
        if "\n" in word or re.search(r"[.!?][^A-Za-z0-9_\x80-\U0010ffff]*$", word.rstrip()):
            sentences.append([])
    lines = []
    for words in filter(None, sentences):
        cuts = {0, len(words)}
        if len(words) > 14:
            sums = [plain_hash(w.rstrip(ld.BLANKS)) for w in words]
            cuts |= {min(range(i, i + 8), key=sums.__getitem__) for i in range(len(words) - 7)}
        cuts = sorted(cuts)
        lines += [words[x:y] for x, y in zip(cuts, cuts[1:])]
    return lines


def brute_force(docs, min_words=25):
    """A word goes if it lies in a run of whole lines of min_words or more that stands in one
    earlier document."""
    held, out = set(), {}
    for i, text in sorted(docs):
        lines = plain_lines(text or "")
        words = [w for line in lines for w in line]
        bare = [w.rstrip(ld.BLANKS) for w in words]
        limits = [0, *itertools.accumulate(map(len, lines))]
        runs = set()
        for x in limits:
            runs |= {(x, y) for y in [z for z in limits if z >= x + min_words][:1]}
            runs |= {(y, x) for y in [z for z in limits if z <= x - min_words][-1:]}
        gone = {k for x, y in runs if tuple(bare[x:y]) in held for k in range(x, y)}
        held |= {tuple(bare[x:y]) for x, y in runs}
        lead = re.match(r"[ \t-\r]*", text or "")[0]
        kept = ("" if 0 in gone else lead) + "".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (kept.rstrip(ld.BLANKS) if len(words) - 1 in gone else kept) if gone else text
    return out


def deleted_words(before, after):
    """Places of the words that went; the rest is the text in its order."""
    return [op for op in difflib.SequenceMatcher(None, before, after, autojunk=False).get_opcodes() if op[0] != "equal"]


def test_query_on_the_whole_table(spark, table):
    docs = [(r.doc_id, r.text) for r in table("documents").collect()]
    found = texts(op3_line_dedup(spark, "/root/testdata/sf0.001"))
    assert found == brute_force(docs)
    assert found != dict(docs)


def test_what_goes_stands_in_one_earlier_document(spark, table):
    """On the whole table, by words alone: 25 in a row around every deleted word."""
    docs = sorted((r.doc_id, r.text or "") for r in table("documents").collect())
    found = texts(op3_line_dedup(spark, "/root/testdata/sf0.001"))
    earlier, n = set(), 0
    for i, text in docs:
        words = text.split()
        covered = set()
        for k in range(len(words) - 24):
            if tuple(words[k : k + 25]) in earlier:
                covered.update(range(k, k + 25))
        for _, a, b, *_ in deleted_words(words, (found[i] or "").split()):
            n += b - a
            assert set(words[a:b]) <= {words[k] for k in covered}, i
            assert any(set(range(x, x + b - a)) <= covered for x in range(max(a - 30, 0), a + 31))
        earlier |= {tuple(words[k : k + 25]) for k in range(len(words) - 24)}
    assert n > 1000


def test_lines_of_several_documents_do_not_add_up(frame):
    lines = [" ".join(f"l{i}w{k}" for k in range(9)) for i in range(3)]
    docs = [*lines, "\n".join([lines[2], lines[0], lines[1]])]
    assert texts(ld.without_repeated_lines(frame(docs))) == dict(enumerate(docs))
    long = "\n".join(lines)
    docs = [lines[1], f"a\n{long}\nb", f"c\n{long}\nd"]  # a part with an earlier holder
    assert texts(ld.without_repeated_lines(frame(docs)))[2] == "c\nd"


def test_blocks_count_by_chain(frame):
    """With short anchors the alignment decides: moved blocks are too short, a whole one goes."""
    lines = [" ".join(f"l{i}w{k}" for k in range(12)) for i in range(4)]
    docs = ["\n".join(lines), "\n".join([lines[2], lines[3], lines[0], lines[1]]), "\n".join(lines[:3])]
    found = texts(ld.without_repeated_lines(frame(docs), anchor_words=8))
    assert found[1] == docs[1] and found[2] == ""
    assert texts(ld.without_repeated_lines(frame(docs), min_words=24, anchor_words=8))[1] == ""


def test_random_lines_match_brute_force(frame):
    rng = random.Random(5)
    pool = [" ".join(f"{i}x{k}" for k in range(rng.randint(0, 14))) for i in range(25)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    assert texts(ld.without_repeated_lines(frame(docs))) == brute_force(docs)


def test_common_blocks_go_from_the_later_document(frame):
    docs = [f"{ODD}\n{P[0]}\n{P[1]}\nown a", f"own b\n{P[0]}\n{P[1]}\n{ODD}", f"{P[1]}\n{P[0]}", f"{ODD}\nown c"]
    found = by_id(ld.without_repeated_lines(frame(docs)))
    assert found[0].text == docs[0] and found[3].text == docs[3]
    assert found[1].text == f"own b\n{ODD}" and (found[1].n_deleted_lines, found[1].n_deleted_words) == (2, 40)
    assert found[2].text == docs[2]  # moved blocks of 20 words
    assert found[1].text.count("\n") == 1


def test_passages_inside_lines_are_found(frame):
    passage = " ".join(f"Start {i} " + " ".join(f"w{i}x{k}" for k in range(9)) + "." for i in range(6))
    docs = [f"one text {passage} goes on", f"Another, longer one {passage} ends? Yes."]
    found = by_id(ld.without_repeated_lines(frame(docs)))
    assert found[0].text == docs[0] and found[1].n_deleted_lines == 5
    first = passage.split(". ")[0]  # goes on from a sentence of its own, so it is another line
    assert found[1].text == f"Another, longer one {first}. ends? Yes."


def test_passages_without_sentence_ends_are_found(frame):
    inside = " ".join(f"i{k}" for k in range(120))
    parted = " ".join(f"o{k}" + "." * (k in (19, 41)) for k in range(62))
    docs = [f"one text {inside} goes on. Then {parted} ends.", f"Quite another {parted} stops. It has {inside} too."]
    found = by_id(ld.without_repeated_lines(frame(docs)))
    kept = found[1].text.split()
    edge = 2 * ld.CUT_WORDS - 2
    assert found[0].text == docs[0]
    assert sum(w[0] == "i" and w[1:].isdigit() for w in kept) <= 2 * edge
    assert sum(w[0] == "o" and w[1:].strip(".").isdigit() for w in kept) <= 2 * edge


def test_every_long_shared_passage_goes_but_for_its_edges(frame):
    rng = random.Random(11)
    edge = 2 * ld.CUT_WORDS - 2
    size = ld.MIN_WORDS + 2 * edge

    def own(i, n):
        return [f"d{i}x{rng.randint(0, 10**6)}" + "." * (rng.random() < rate) for _ in range(n)]

    docs, placed = [], []
    for i in range(40):
        rate = rng.choice([0, 0.02, 0.1, 0.3])
        passage = [f"p{i}x{k}" + "." * (rng.random() < rate) for k in range(size + rng.randint(0, 60))]
        for side in "ab":
            docs.append(" ".join([*own(f"{i}{side}", rng.randint(1, 40)), *passage, *own(f"{i}{side}", rng.randint(1, 40))]))
        placed.append(passage)
    found = texts(ld.without_repeated_lines(frame(docs)))
    for i, passage in enumerate(placed):
        assert found[2 * i] == docs[2 * i]
        kept = set(found[2 * i + 1].split())
        assert not kept & set(passage[edge:-edge]), (i, kept & set(passage))
        assert {w for w in docs[2 * i + 1].split() if w[0] == "d"} <= kept | set()


def test_a_short_sentence_at_the_edge_costs_its_neighbour_nothing(frame):
    passage = " ".join(f"s{i} " + " ".join(f"w{i}x{k}" for k in range(12)) + "." for i in range(2))
    docs = [f"{passage} Yes. End of one.", f"No, no. {passage} Other end."]
    assert texts(ld.without_repeated_lines(frame(docs)))[1] == "No, no. Other end."


def test_blank_lines_do_not_part_a_passage(frame):
    for gap in ["\n\n", "\n \n", "\n\n\n\t\n"]:
        docs = [f"own{gap}{gap.join(P[:5])}{gap}end", f"{gap}mine{gap}{gap.join(P[:5])}{gap}other"]
        assert texts(ld.without_repeated_lines(frame(docs))) == {0: docs[0], 1: f"{gap}mine{gap}other"}


def test_lines_match_plain_ones():
    rng = random.Random(3)
    odd = ["a", "b.", "c?)", "é", "ü.", "d.e", "...", "x_", "“q.”", "—", "1.", "\x00", "\x85"]
    gaps = [" ", "  ", "\n", " \n\n ", "\t", "\r\n"]
    some = ["", " ", "\n\n", "a", " . x"]
    some += ["".join(rng.choice(odd) + rng.choice(gaps[: rng.randint(1, 6)]) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    lines = ld.lines_of(some)
    found = [[] for _ in some]
    for own, a, b in zip(lines.line_texts, lines.line_starts, lines.line_ends):
        found[own].append(int(b - a))
    assert found == [[len(x) for x in plain_lines(text)] for text in some]
    for i, text in enumerate(some):
        assert [int(h) for h in lines.hashes[lines.first_words[i] : lines.first_words[i + 1]]] == [
            plain_hash(w.rstrip(ld.BLANKS)) for w in WORD.findall(text)
        ]
    large = " ".join(["y" * 70_000, *(f"w{k}" for k in range(400_000))])
    assert [int(h) for h in ld.lines_of([large]).hashes[-3:]] == [plain_hash(f"w{399_997 + k}") for k in range(3)]


def test_short_lines_go_with_their_block_only(frame):
    block = "\n".join(f"s{i} t{i} u{i}" for i in range(12))
    found = texts(ld.without_repeated_lines(frame([f"x\n{block}\ny", f"{block}\nmine", "s3 t3 u3\nmine"])))
    assert found[1] == "mine" and found[2] == "s3 t3 u3\nmine"


def test_nulls_empties_repeats_and_clashing_columns(frame):
    docs = [(3, None), (1, ""), (7, P[0] + "\n" + P[1]), (7, P[0] + "\n" + P[1]), (None, P[0] + "\n" + P[1]), (8, "\n".join(P * 400))]
    df = frame(docs, _spans="a", uid="b", n_deleted_lines="c", anchor="d")
    found = ld.without_repeated_lines(df)
    rows = {(r.doc_id, r.text) for r in found.collect()}
    assert found.count() == 6 and (None, P[0] + "\n" + P[1]) in rows  # null ids are earliest
    assert (7, "") in rows and (3, None) in rows and (1, "") in rows
    assert {r.uid for r in found.collect()} == {"b"}
    assert ld.without_repeated_lines(frame([])).collect() == []


def test_one_passage_in_a_third_of_all_documents(frame):
    docs = [f"own {i}\n{P[2]}\n{P[3]}\nend {i}" if i % 3 == 0 else f"other text {i}" for i in range(90)]
    found = texts(ld.without_repeated_lines(frame(docs)))
    assert found[0] == docs[0]
    assert all(found[i] == (f"own {i}\nend {i}" if i % 3 == 0 else docs[i]) for i in range(1, 90))


def test_patience_chains_take_every_match_once():
    places = [(0, 5), (1, 6), (2, 0), (3, 1), (4, 2), (5, 7)]
    chains = ld.patience_chains(places)
    assert chains[0] == [(2, 0), (3, 1), (4, 2), (5, 7)] and chains[1] == [(0, 5), (1, 6)]
    down = [(i, 9 - i) for i in range(5)]
    assert sorted(m for c in ld.patience_chains(down) for m in c) == down
