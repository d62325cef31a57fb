"""Chat formatting in budgeted windows with loss masks.

A conversation's turns are laid out in windows of a token budget, cut between
turns only. Running sums of the turns' tokens decide where a window ends and
how far back its history reaches. Every window starts with the conversation's
system turn and repeats the last turns before it as far as a smaller budget
allows; repeated turns are masked, so every assistant turn is a target once.

Turns go by in order and only one window is held, so a conversation may be of
any length.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerly.llm.bpe import vocabulary

#: The template's marks.
OPEN, BEGIN, CLOSE = "<s>", "[INST]", "[/INST]</s>\n"
#: Control strings as texts may hold them, with the backslashes that mark them as text.
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|</?SYS>)")
TARGET = "assistant"
SYSTEM = "system"


def escape(text: str) -> str:
    """Control strings get a backslash after their first character, one more than they have."""
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(the turn in the template, start and end of its text in it)."""
    head = OPEN + escape(role) + BEGIN
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse_turns(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and end of the escaped text) of every turn of a formatted window."""
    out, at = [], 0
    while at < len(text):
        begin = text.index(BEGIN, at) + len(BEGIN)
        end = text.index(CLOSE, begin)
        out.append((unescape(text[at + len(OPEN):begin - len(BEGIN)]), unescape(text[begin:end]), begin, end))
        at = end + len(CLOSE)
    return out


def turn_tokens(role: Column, text: Column, tokenizer: str) -> Column:
    """Tokens of a turn in the template, marks and escapes included."""
    @F.arrow_udf("int")
    def count(roles: pa.Array, texts: pa.Array) -> pa.Array:
        turns = [format_turn(r, t)[0] for r, t in zip(roles.to_pylist(), texts.to_pylist())]
        return pa.array([len(ids) for ids in vocabulary(tokenizer).encode_all(pa.array(turns, pa.string()))], pa.int32())
    return count(role, text)


class Windows:
    """Lays out one conversation, turn by turn."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple | None = None
        self.turns: deque = deque()  # the window's turns: (running sum before, tokens, role, text, repeated)
        self.sum, self.fresh, self.first, self.system_shown = 0, 0, True, False

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """Take the next turn; the window that it ends, if any."""
        done = None
        room = self.budget - (self.system[1] if self.system else 0)
        if self.fresh and self.turns and self.sum + tokens - self.turns[0][0] > room:
            done = self.close()
            least = max(self.sum - self.history, self.sum + tokens - room)  # history fits its budget and leaves room for the turn
            while self.turns and self.turns[0][0] < least:
                self.turns.popleft()
            self.turns = deque((*t[:4], True) for t in self.turns)
            self.fresh = 0
        turn = (self.sum, tokens, role, text, False)
        if self.first and role == SYSTEM:
            self.system = turn
        else:
            self.turns.append(turn)
            self.sum += tokens
        self.first = False
        self.fresh += 1
        return done

    def close(self) -> dict:
        """The window as text, the spans of its targets, and how many of its turns are repeated."""
        text, spans, repeated, size = [], [], 0, 0
        shown = [(*self.system[:4], self.system_shown)] if self.system else []
        for _, _, role, words, again in [*shown, *self.turns]:
            turn, begin, end = format_turn(role, words)
            if again:
                repeated += 1
            elif role == TARGET:
                spans.append({"start": size + begin, "end": size + end})
            text.append(turn)
            size += len(turn)
        self.system_shown = True
        return {"text": "".join(text), "targets": spans, "repeated": repeated}


def format_chats(turns: DataFrame, tokenizer: str, budget: int = 1024, history: int = 256, conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: conv_id, window, text, targets (spans under the loss mask), repeated (turns repeated at its start).

    A first turn whose role is system opens every window. Turns are counted as
    the template shows them, marks and escapes included, where they are read,
    before conversations are brought together; a window's turns add up to the
    budget at most. A window has at least one new turn; a turn longer than the budget has a window of its own
    beside the system turn, and none is cut. Null roles and texts are empty;
    rows without a conv_id are one conversation; equal turn numbers go by role
    and text, null numbers last, and repeated rows stay. Control strings in
    roles and texts are escaped. ``tokenizer`` is the path of a byte-level
    tokenizers file. Other columns are not read. An empty table gives no rows.
    """
    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("window", pa.int32()), ("text", pa.string()),
                            ("targets", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("repeated", pa.int32())])
        conv, windows, n, out = None, None, 0, []
        def ended(window):
            nonlocal n
            n += 1
            return {"conv_id": conv, "window": n - 1} | window
        for batch in batches:
            for row in batch.to_pylist():
                if windows is None or row["conv_id"] != conv:
                    if windows is not None:
                        out.append(ended(windows.close()))
                    conv, windows, n = row["conv_id"], Windows(budget, history), 0
                if (window := windows.add(row["role"], row["text"], row["tokens"])) is not None:
                    out.append(ended(window))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if windows is not None:
            yield pa.RecordBatch.from_pylist([ended(windows.close())], schema)

    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", turn_tokens(F.col("role"), F.col("text"), tokenizer))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
    return dealt.select("conv_id", "role", "text", "tokens").mapInArrow(
        lay_out, "conv_id long, window int, text string, targets array<struct<start: int, end: int>>, repeated int")


def write_chats(turns: DataFrame, path: str, tokenizer: str, **options) -> None:
    """Write the windows of ``format_chats`` as parquet."""
    format_chats(turns, tokenizer, **options).write.parquet(path)


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """Digests of what written windows hold, one row per conversation.

    conv_id, n_turns, turns_sha256 (role, line end, text, line end of every
    turn, repeats left out), loss_chars and loss_sha256 (all text under the
    mask), formatted_chars (code points of all windows). Windows are read in
    order, one at a time.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        now, out = None, []
        def row():
            return {"conv_id": now[0], "n_turns": now[1], "turns_sha256": now[2].hexdigest(), "loss_chars": now[3],
                    "loss_sha256": now[4].hexdigest(), "formatted_chars": now[5]}
        for batch in batches:
            for r in batch.to_pylist():
                if now is None or r["conv_id"] != now[0]:
                    if now is not None:
                        out.append(row())
                    now = [r["conv_id"], 0, sha256(), 0, sha256(), 0]
                for role, text, _, _ in parse_turns(r["text"])[r["repeated"]:]:
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                for span in r["targets"]:
                    target = unescape(r["text"][span["start"]:span["end"]])
                    now[3] += len(target)
                    now[4].update(target.encode())
                now[5] += len(r["text"])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([row()], schema)

    rows = spark.read.schema("conv_id long, window int, text string, targets array<struct<start: int, end: int>>, repeated int") \
        .parquet(path)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(
        digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
