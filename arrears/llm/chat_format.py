"""Conversations as training texts: windows of whole turns under a token budget.

Template, with the control strings as they stand:

    system      [SYS]text[/SYS]
    user        <s>[INST]text[/INST]
    assistant   [ANS]text</s>
    other       [TURN]role[ROLE]text[/TURN]     (a null role: [TURN][ROLE]text[/TURN])

Every ``<``, ``[`` and ``\\`` of a text or role is escaped with a backslash behind it, so no
control string can come from a text and the escape can be undone.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.llm.batches import spans_by_size
from arrears.llm.pieces import PieceModel, safe_parts
from arrears.sources.staging import stage

MARKS = {
    "system": ("[SYS]", "[/SYS]"),
    "user": ("<s>[INST]", "[/INST]"),
    "assistant": ("[ANS]", "</s>"),
}
OTHER, ROLE_END, OTHER_END = "[TURN]", "[ROLE]", "[/TURN]"
TARGET = "assistant"
BUDGET = 2048  # tokens of a window
HISTORY = 512  # tokens of earlier turns that a window repeats, at most
BLOCK_TURNS = 4096  # turns that are packed together; a window ends there too
GRAIN = 64  # a block is put together from about so many ranges of turn numbers

_TURN = re.compile(
    r"(?P<system>\[SYS\])|(?P<user><s>\[INST\])|(?P<assistant>\[ANS\])|(?P<other>\[TURN\])"
)


def escaped(text: str) -> str:
    return re.sub(r"[<\[\\]", lambda m: m[0] + "\\", text)


def unescaped(text: str) -> str:
    return re.sub(r"([<\[\\])\\", r"\1", text)


def formatted_turn(role: str | None, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its escaped text begins and ends."""
    if role in MARKS:
        start, end = MARKS[role]
    else:
        start, end = OTHER + ("" if role is None else "=" + escaped(role)) + ROLE_END, OTHER_END
    body = escaped(text)
    return start + body + end, len(start), len(start) + len(body)


def parsed_turns(formatted: str) -> list[tuple[str | None, str, int, int]]:
    """Role, text, and begin and end of the escaped text, of every turn of a window."""
    turns, at = [], 0
    while at < len(formatted):
        mark = _TURN.match(formatted, at)
        if not mark:
            raise ValueError(f"no turn begins at {at}")
        role, at = mark.lastgroup, mark.end()
        closing = OTHER_END if role == "other" else MARKS[role][1]
        if role == "other":
            stop = formatted.index(ROLE_END, at)
            own = formatted[at:stop]
            role = unescaped(own[1:]) if own else None
            at = stop + len(ROLE_END)
        stop = formatted.index(closing, at)
        turns.append((role, unescaped(formatted[at:stop]), at, stop))
        at = stop + len(closing)
    return turns


WINDOWS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("window", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("n_repeated", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("loss_begins", T.ArrayType(T.IntegerType(), False)),
        T.StructField("loss_ends", T.ArrayType(T.IntegerType(), False)),
    ]
)


class _Packer:
    """Packs the turns of one block of a conversation, given in order."""

    def __init__(self, key: tuple, budget: int, history: int) -> None:
        self.key, self.budget, self.history = key, budget, history
        self.system: tuple | None = None
        self.turns: list[tuple] = []  # (role, text, tokens): history, then the window's own
        self.repeated = 0
        self.windows = 0
        self.waiting: deque[tuple] = deque()  # of the halo, the last turns that fit into history
        self.waiting_tokens = 0
        self.began = False

    def halo(self, turn: tuple, is_system: bool) -> None:
        if is_system:
            self.system = turn
        elif turn != self.system:
            self.waiting.append(turn)
            self.waiting_tokens += turn[2]
            while self.waiting_tokens > self.history:
                self.waiting_tokens -= self.waiting.popleft()[2]

    def add(self, turn: tuple, is_system: bool) -> Iterator[tuple]:
        if not self.began:
            self.began = True
            self.turns = self._repeat(list(self.waiting), turn[2])
            self.repeated = len(self.turns)
        elif self._tokens() + turn[2] > self.budget:
            yield self._window()
            self.turns = self._repeat(self.turns, turn[2])
            self.repeated = len(self.turns)
        if is_system and self.system is None:
            self.system = turn
        self.turns.append(turn)

    def end(self) -> Iterator[tuple]:
        if len(self.turns) > self.repeated:
            yield self._window()

    def _tokens(self) -> int:
        return sum(t[2] for t in self.turns)

    def _repeat(self, turns: list[tuple], coming: int) -> list[tuple]:
        """The system turn, and the last turns that fit beside it and the coming turn.

        ``upto`` are prefix sums of tokens, the latest turn first.
        """
        fixed = [self.system] if self.system else []
        room = self.budget - coming - sum(t[2] for t in fixed)
        room = min(room, self.history)
        kept: list[tuple] = []
        upto = 0
        for turn in reversed([t for t in turns if t != self.system]):
            upto += turn[2]
            if upto > room:
                break
            kept.append(turn)
        return fixed + kept[::-1]

    def _window(self) -> tuple:
        text, begins, ends = "", [], []
        for i, (role, body, _) in enumerate(self.turns):
            piece, start, end = formatted_turn(role, body)
            if i >= self.repeated and role == TARGET:
                begins.append(len(text) + start)
                ends.append(len(text) + end)
            text += piece
        row = (*self.key, self.windows, text, self.repeated, self._tokens(), begins, ends)
        self.windows += 1
        return row


def chat_windows(
    conversations: DataFrame,
    model: bytes,
    budget: int = BUDGET,
    history: int = HISTORY,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """Formatted windows of every conversation, and the spans that count for the loss.

    ``conversations`` has conv_id, turn, role, text; other columns do not matter. The
    turns of a conversation are in the order of turn (null first), then role, then text.
    Windows hold whole turns. One begins with the system turn (the first of its role) and
    at most ``history`` tokens of the latest turns before it, then come new turns while
    their prefix sum of tokens stays within ``budget``; each turn is new in one window
    only. A turn that alone exceeds the budget gets a window of its own and is not cut. The
    loss spans (character ranges of ``formatted``) cover the texts of new assistant turns;
    repeated ones are masked. Tokens are those of the template's pieces for ``model``.

    A null text is the empty text, a null role a role of its own, a null conv_id a
    conversation of its own; repeated rows are turns of their own. An empty table gives no
    windows.

    Turns are dealt by conversation and by blocks of about ``block_turns`` turns, counted in
    order whatever their numbers are, so a conversation of any length spreads over tasks and
    each task streams through its blocks holding one window. A window ends with its block;
    turns of one number are in one block. A block gets copies of the system turn and of the
    last ``history`` turns before it; those that fit into ``history`` tokens serve as its
    history, and as a turn has a token or more, no others could.
    """
    spark = conversations.sparkSession
    shared = spark.sparkContext.broadcast(model)
    grain = max(1, block_turns // GRAIN)
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / grain), F.lit(-(2**62))).alias("range"),
    )
    # Conversations of one range of turn numbers are one block. In others ranges are counted.
    sizes = rows.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    conversation = Window.partitionBy("conv_id")
    end = F.sum("n").over(conversation.orderBy("range"))
    counted = sizes.withColumns({"end": end, "ranges": F.count(F.lit(1)).over(conversation)})
    own_block = F.floor((F.col("end") - F.col("n")) / block_turns)
    # A later block begins behind the range, and the range is near if at most history turns are between.
    near_first = F.greatest(own_block + 1, F.floor(F.col("end") / block_turns))
    near_last = F.floor((F.col("end") + (history - 1)) / block_turns)
    near_blocks = F.when(near_first <= near_last, F.sequence(near_first, near_last))
    placed = stage(
        counted.where("ranges > 1").select(
            F.col("conv_id").alias("c"),
            F.col("range").alias("r"),
            own_block.alias("block"),
            near_blocks.alias("near_blocks"),
        )
    )
    rows = (
        rows.join(placed, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")), "left")
        .withColumns({"block": F.coalesce("block", F.lit(0).cast("bigint")), "kind": F.lit(2)})
        .drop("c", "r", "range")
    )
    history_rows = rows.withColumns({"block": F.explode("near_blocks"), "kind": F.lit(1)}).drop("near_blocks")
    rows = rows.drop("near_blocks")
    # Only conversations of several blocks need their system turn in the later ones.
    later = placed.where("block > 0").select(F.col("c").alias("conv_id"), F.col("block").alias("to_block")).distinct()
    order = F.struct(F.coalesce("turn", F.lit(-(2**62))).alias("t"), "text")
    systems = rows.where(F.col("role") == "system").groupBy("conv_id").agg(F.min(order).alias("s"))
    system_rows = (
        systems.withColumnRenamed("conv_id", "c")
        .join(later, F.col("c").eqNullSafe(F.col("conv_id")))
        .select(
            "conv_id",
            F.col("s.t").alias("turn"),
            F.lit("system").alias("role"),
            F.col("s.text").alias("text"),
            F.col("to_block").alias("block"),
            F.lit(0).alias("kind"),
        )
    )
    dealt = (
        rows.unionByName(history_rows)
        .unionByName(system_rows)
        .repartition("conv_id", "block")
        .sortWithinPartitions("conv_id", "block", "kind", "turn", "role", "text")
        .select("conv_id", "block", "kind", "role", "text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel(shared.value)
        processor = pieces.processor()

        def tokens(texts: list[str]) -> list[int]:
            found = [0] * len(texts)
            parts = [
                (i, p)
                for i, t in enumerate(texts)
                for p in (safe_parts(t, 20_000) if pieces.cuts_at_spaces else [t])
            ]
            for a, b in spans_by_size([len(p) for _, p in parts], 500_000):
                ids = processor.encode([p for _, p in parts[a:b]], num_threads=1)
                for (i, _), own in zip(parts[a:b], ids, strict=True):
                    found[i] += len(own)
            return found

        packer: _Packer | None = None
        out: list[tuple] = []
        held = 0
        for batch in batches:
            conv, block, kind, roles, texts = [c.to_pylist() for c in batch.columns]
            sizes = tokens([formatted_turn(r, t)[0] for r, t in zip(roles, texts, strict=True)])
            for c, b, k, role, text, size in zip(conv, block, kind, roles, texts, sizes, strict=True):
                if packer is None or packer.key != (c, b):
                    if packer:
                        out += packer.end()
                    packer = _Packer((c, b), budget, history)
                turn = (role, text, size)
                if k < 2:
                    packer.halo(turn, k == 0)
                else:
                    new = list(packer.add(turn, role == "system"))
                    out += new
                    held += sum(len(w[3]) for w in new)
                if held > 1_000_000 or len(out) > 5_000:
                    yield _rows(out)
                    out, held = [], 0
        if packer:
            out += packer.end()
        if out:
            yield _rows(out)

    return dealt.mapInArrow(run, WINDOWS)


def _rows(windows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
    kinds += [pa.list_(pa.int32()), pa.list_(pa.int32())]
    columns = [pa.array(c, k) for c, k in zip(zip(*windows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=WINDOWS.names)


READ_BACK = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
        T.StructField("n_windows", T.LongType()),
    ]
)


def read_back(windows: DataFrame) -> DataFrame:
    """Turns and loss text of every conversation, read from its windows alone.

    Returns conv_id, n_turns, turns_sha256 (over role, line break, text, line break of
    each turn), loss_chars and loss_sha256 (over the unescaped text under the loss spans),
    formatted_chars and n_windows. A null role is read as the empty one here. A digest of
    a whole conversation needs its windows in order, so they stream through one task per
    conversation, one window at a time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None
        out: list[tuple] = []

        def closed() -> tuple:
            conv, n, turns, chars, loss, length, count = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length, count

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or state[0] != row["conv_id"]:
                    if state:
                        out.append(closed())
                    state = [row["conv_id"], 0, sha256(), 0, sha256(), 0, 0]
                text = row["formatted"]
                for role, body, _, _ in parsed_turns(text)[row["n_repeated"] :]:
                    state[1] += 1
                    state[2].update(f"{role or ''}\n{body}\n".encode())
                for begin, end in zip(row["loss_begins"], row["loss_ends"], strict=True):
                    target = unescaped(text[begin:end])
                    state[3] += len(target)
                    state[4].update(target.encode())
                state[5] += len(text)
                state[6] += 1
            if len(out) > 5_000:
                yield _read_rows(out)
                out = []
        if state:
            out.append(closed())
        if out:
            yield _read_rows(out)

    return (
        windows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "block", "window")
        .select("conv_id", "formatted", "n_repeated", "loss_begins", "loss_ends")
        .mapInArrow(run, READ_BACK)
    )


def _read_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=READ_BACK.names)
