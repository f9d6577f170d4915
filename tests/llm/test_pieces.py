from hashlib import sha256

import pytest
from arrears.llm import pieces, sentencepiece_codec, token_counts
from arrears.llm.catalog import op2_sentencepiece, op6_token_counts

from .conftest import by_id

ODD = [
    None, "", " ", "   ", "a", " a  b ", "x▁y ▁ z", "tab\tand\nline\r\n", "é漢字 🙂🙂 ả",
    "<s> </s> <unk> <0x41>", "a" * 3000, "word " * 9000, "no-break space thin", "\x00\x01",
]


@pytest.fixture(scope="module")
def library(model):
    return pieces.PieceModel(model).processor()


def digest(text):
    return sha256(text.encode()).hexdigest()


def test_encoding_equals_the_library_and_spans_tile_the_source(frame, model, library):
    found = by_id(sentencepiece_codec.encode_decode(frame(ODD, ids="x", ends="y"), model))
    for i, text in enumerate(ODD):
        text = text or ""
        ids = library.encode(text)
        assert found[i]["ids"] == ids and found[i].decoded == library.decode(ids)
        data, at = text.encode(), 0
        for piece, end in zip(ids, found[i].ends, strict=True):
            assert at <= end
            name = library.id_to_piece(piece)
            surface = data[at:end].decode(errors="replace").replace(" ", "▁")
            if at and not library.is_byte(piece):
                assert name == surface
            at = end
        assert at == len(data)


def test_query_and_counts_on_whole_tables(spark, table, library):
    folder = "/root/testdata/sf0.001"
    coded, counted = by_id(op2_sentencepiece(spark, folder)), by_id(op6_token_counts(spark, folder))
    docs = table("documents").collect()
    assert len(coded) == len(counted) == len(docs)
    for d in docs:
        ids = library.encode(d.text)
        c, n = coded[d.doc_id], counted[d.doc_id]
        assert c.n_tokens == n.n_tokens == len(ids) and c.spans_cover
        assert c.ids_sha256 == digest(",".join(map(str, ids)))
        assert c.decoded_sha256 == digest(library.decode(ids))
        assert n.n_bytes == len(d.text.encode()) and n.over_limit == (len(ids) > 4096)


def test_counts_of_parts_add_up(frame, model, library):
    texts = [*ODD, "an end. " * 5000, "x " * 700 + " " * 900 + "y"]
    found = by_id(token_counts.token_counts(frame(texts), model, 100, part_characters=40, batch_bytes=300))
    for i, text in enumerate(texts):
        n = len(library.encode(text or ""))
        assert (found[i].n_tokens, found[i].over_limit) == (n, n > 100)


def test_empty_tables_and_repeated_rows(frame, model):
    assert sentencepiece_codec.encode_decode(frame([]), model).collect() == []
    assert token_counts.token_counts(frame([]), model).collect() == []
    rows = token_counts.token_counts(frame([(None, "a b"), (None, "a b")]), model).collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_safe_parts_cut_at_single_spaces_only():
    text = "aa bb  cc ▁dd ee\nff gg"
    parts = pieces.safe_parts(text, 1)
    assert parts == ["aa", "bb  cc ▁dd", "ee\nff", "gg"]
    assert " ".join(parts) == text


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normaliser_follows_a_compiled_map(rule):
    from sentencepiece import SentencePieceNormalizer

    made = SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    own = pieces.PieceModel(made.serialized_model_proto()).normalizer
    for text in [*ODD, "ﬁne ①②  Ｆｕｌｌ　width ㍿ ", "é i̇ Å ½", "STRASSE ß"]:
        text = text or ""
        data, source = own(text)
        assert data.decode() == made.normalize(text)
        assert len(source) == len(data) + 1
        assert all(a <= b for a, b in zip(source, source[1:], strict=False)) and source[-1] <= len(text.encode())
