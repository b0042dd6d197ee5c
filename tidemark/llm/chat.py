r"""Chat formatting with budgeted windows.

Prefix sums of turn tokens choose spans of whole turns that fit a token budget. Every window begins
with the conversation's system turn, repeats a limited stretch of the turns before it, and then holds
its new turns; only new assistant turns count towards the loss, so each is a target exactly once.

Template: `<|im_start|>` role, newline, text, `<|im_end|>`, newline. Inside texts and roles each `<`
that some backslashes and a `|` follow gets one backslash more, so no control string is left, and
taking one away restores the text.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import batch_of, prepare, table
from tidemark.llm.packing import RANKS, tokenizer_path, tokens_of

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"

_OPEN, _CLOSE = "<|im_start|>", "<|im_end|>\n"
_HIDE, _SHOW = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)
#: what the control strings and the newlines of a turn cost, in tokens
TURN_COST = 4


def hide(text: str) -> str:
    return _HIDE.sub(r"<\\\1|", text)


def show(text: str) -> str:
    return _SHOW.sub(r"<\1|", text)


def hide_role(role: str) -> str:
    return hide(role.replace("\\", "\\\\").replace("\n", "\\n"))


def show_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], show(role))


class _Builder:
    """Windows of one conversation, fed turn by turn; holds no more than one window and its history.

    `sums` are the prefix sums of the tokens of the held turns: a window is a span of turns between two of
    them, and so is the history that the next one repeats.
    """

    def __init__(self, conv_id, budget: int, history_turns: int, history_tokens: int):
        self.conv_id, self.budget, self.history_turns, self.history_tokens = conv_id, budget, history_turns, history_tokens
        self.system: tuple[str, str, int] | None = None
        self.turns: list[tuple[str, str, int]] = []
        self.sums = [0]
        self.fresh = 0  # held turns before are history
        self.number = 0

    def _system_tokens(self) -> int:
        return self.system[2] if self.system else 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[tuple]:
        if self.new and self._system_tokens() + self.sums[-1] - self.sums[0] + tokens > self.budget:
            yield self.window()
            self._start(tokens)
        self.turns.append((role, text, tokens))
        self.sums.append(self.sums[-1] + tokens)

    @property
    def new(self) -> bool:
        return len(self.turns) > self.fresh

    def _start(self, tokens: int) -> None:
        """Open the next window: the system turn, then as much history as limits and budget allow."""
        first = 0
        if self.number == 1 and self.turns[0][0] == SYSTEM_ROLE:
            self.system, first = self.turns[0], 1
        held = len(self.turns)
        room = min(self.history_tokens, self.budget - tokens - self._system_tokens())
        first = bisect.bisect_left(self.sums, self.sums[-1] - room, max(first, held - self.history_turns), held)
        self.turns, self.sums = self.turns[first:], self.sums[first:]
        self.fresh = len(self.turns)

    def window(self) -> tuple:
        system = [self.system] if self.system else []
        repeated = len(system) + self.fresh
        parts, spans, at = [], [], 0
        for i, (role, text, _) in enumerate([*system, *self.turns]):
            head, body = f"{_OPEN}{hide_role(role)}\n", hide(text)
            parts += [head, body, _CLOSE]
            at += len(head)
            if i >= repeated and role == TARGET_ROLE:
                spans += [at, at + len(body)]
            at += len(body) + len(_CLOSE)
        tokens = self._system_tokens() + self.sums[-1] - self.sums[0]
        row = (self.conv_id, self.number, "".join(parts), repeated, spans, tokens)
        self.number += 1
        return row


def format_windows(turns: DataFrame, tokenizer: str, ranks: str | None = None, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                   history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """(conv_id, window, formatted, repeated_turns, loss_spans, tokens) of conversations.

    Input rows: conv_id, turn, role, text; other columns are not read. Turns are ordered by turn, then
    role and text, nulls first; repeated rows are repeated turns; null roles and texts are empty, and
    rows without conv_id make one conversation. A first turn of role system is the one retained. A
    turn longer than the budget gets a window of its own, whole, so only such windows pass the budget.
    `loss_spans` are code point positions (start, end, ...) in `formatted`; the first `repeated_turns`
    turns of a window appeared before. An empty table gives no rows.

    One shuffle by conversation; a task streams its sorted turns and holds one window at a time, so a
    conversation may have any number of turns.
    """
    prepare(turns.sparkSession)
    schema = StructType([
        turns.schema["conv_id"], StructField("window", IntegerType()), StructField("formatted", StringType()),
        StructField("repeated_turns", IntegerType()), StructField("loss_spans", ArrayType(IntegerType())), StructField("tokens", LongType())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens_of(tokenizer, ranks).encode
        builder = None
        for batch in batches:
            out: list[tuple] = []
            for conv, _, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if builder is None or builder.conv_id != conv:
                    if builder is not None:
                        out.append(builder.window())
                    builder = _Builder(conv, budget, history_turns, history_tokens)
                role, text = role or "", text or ""
                cost = (len(encode(hide_role(role))) + len(encode(hide(text)))) // 4 + TURN_COST
                out.extend(builder.add(role, text, cost))
            yield batch_of(out, schema)
        if builder is not None:
            yield batch_of([builder.window()], schema)

    ordered = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(build, schema)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window."""
    return [(show_role(m[1]), show(m[2])) for m in _TURN.finditer(formatted)]


def read_back(windows: DataFrame) -> DataFrame:
    """Digest per conversation of the output of format_windows, which is still in its order."""
    schema = StructType([
        windows.schema["conv_id"], StructField("n_turns", LongType()), StructField("turns_sha256", StringType()),
        StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def row() -> tuple:
            return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for batch in batches:
            out: list[tuple] = []
            wanted = (batch.column(c).to_pylist() for c in ("conv_id", "formatted", "repeated_turns", "loss_spans"))
            for key, text, repeated, spans in zip(*wanted, strict=True):
                if state is None or key != conv:
                    if state is not None:
                        out.append(row())
                    conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse(text)[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                for a, b in zip(spans[::2], spans[1::2], strict=True):
                    target = show(text[a:b])
                    state[2] += len(target)
                    state[3].update(target.encode())
                state[4] += len(text)
            yield batch_of(out, schema)
        if state is not None:
            yield batch_of([row()], schema)

    return windows.mapInArrow(digest, schema)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return read_back(format_windows(turns.unionByName(probe), tokenizer_path(), tokenizer_path(RANKS)))
