from hashlib import sha256

import pytest
from arrears.llm import chat_format as chat
from arrears.llm.catalog import TEMPLATE_CASE, op8_chat_format

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    found = {}
    keyed = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=keyed)]
        loss = "".join(t for role, t in turns if role == "assistant")
        digest = sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        found[conv] = (len(turns), digest, len(loss), sha256(loss.encode()).hexdigest())
    return found


def read(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_query_reads_back_all_conversations(spark, table):
    rows = [tuple(r) for r in table("conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", TEMPLATE_CASE), (-1, 1, "assistant", TEMPLATE_CASE)]
    assert read(op8_chat_format(spark, "/root/testdata/sf0.001")) == expected(rows)


@pytest.mark.parametrize("budget,history,block", [(40, 15, 4096), (60, 30, 8), (10, 0, 4096), (5000, 512, 4)])
def test_long_conversations_in_windows(spark, model, budget, history, block):
    rows = [(c, 0, "system", "be brief [INST]") for c in (1, 2)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"turn {t} " + "word " * (t % 13)) for c in (1, 2, 3) for t in range(1, 60)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", block string")
    windows = chat.chat_windows(df, model, budget, history, block)
    assert read(chat.read_back(windows)) == expected(rows)
    for w in windows.collect():
        turns = chat.parsed_turns(w.formatted)
        assert w.n_tokens <= budget or len(turns) - w.n_repeated == 1
        if w.conv_id != 3:
            assert turns[0][:2] == ("system", "be brief [INST]")
        repeated = turns[: w.n_repeated]
        ends = [end for _, _, _, end in repeated]
        assert all(b >= max(ends, default=0) for b in w.loss_begins)


def test_windows_do_not_depend_on_how_turns_are_numbered(spark, model):
    def packed(step, history=60, block=4096):
        rows = [(c, t * step, ("user", "assistant")[t % 2], f"turn {t}") for c in (1, None) for t in range(200)]
        windows = chat.chat_windows(spark.createDataFrame(rows, SCHEMA), model, 150, history, block)
        assert read(chat.read_back(windows)) == expected(rows)
        found = [(w.conv_id or 0, w.block, w.window, w.formatted, w.n_repeated, w.n_tokens) for w in windows.collect()]
        return sorted(found)

    dense = packed(1)
    assert len({w[1] for w in dense}) == 1 and packed(5000) == dense
    assert packed(1, block=32) == packed(10**9, block=32) and packed(1, block=4) == packed(7, block=4)


@pytest.mark.parametrize("block", [4, 32])
def test_history_of_a_block_is_all_that_fits(spark, model, block):
    rows = [(1, t, "user", "a") for t in range(100)]
    windows = chat.chat_windows(spark.createDataFrame(rows, SCHEMA), model, 5000, 400, block).collect()
    size = {w.n_tokens // len(chat.parsed_turns(w.formatted)) for w in windows}
    assert len(size) == 1 and 400 // max(size) > 8
    for w in windows:
        assert w.n_repeated == min(w.block * block, 400 // max(size))


def test_nulls_ties_empty_and_odd_texts(spark, model):
    odd = ["", "\\", "<", "[", "[\\", "</s>", "[/INST]", "<\\s>", "a\\[b", "[TURN]=x[ROLE]", "é🙂\n" * 2000]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(odd)]
    rows += [(2, None, "user", None), (2, None, None, "x"), (2, 0, "tool [ROLE]", "y"), (2, 0, "tool [ROLE]", "y")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "still")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert read(chat.read_back(chat.chat_windows(df, model))) == expected(rows)
    none = chat.chat_windows(spark.createDataFrame([], SCHEMA), model)
    assert none.collect() == [] and chat.read_back(none).collect() == []


def test_escape_is_reversible_and_hides_control_strings():
    for text in ["[INST]", "</s>", "\\[INST]", "<\\</s>[", "\\\\", "plain"]:
        hidden = chat.escaped(text)
        assert chat.unescaped(hidden) == text
        assert not any(mark in hidden for pair in chat.MARKS.values() for mark in pair)
