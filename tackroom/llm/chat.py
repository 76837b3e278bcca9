"""Chat formatting in budgeted windows (operator 8).

Turns of a conversation are dealt to one task in turn order (a shuffle by
conversation; the sort spills to disk) and streamed: no conversation is held as
a whole. Running sums of turn sizes choose spans of whole turns: a window holds
the system turn, the repeated end of what came before (up to a part of the
budget) and as many new turns as fit. Text under the loss mask is each
assistant turn at its first appearance; repeated ones are masked out.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"   # control strings of the template (fixed values)
BUDGET = 2048      # tokens of a window
HISTORY = 512      # of them, at most, for repeated turns
_TOKEN = re.compile(r"\w{1,6}|[^\w\s]")
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_ROLE = re.compile(r"\\(.)", re.S)

WINDOW_SCHEMA = ("conv_id long, window long, first_turn long, n_turns long, n_repeated long, n_tokens long, "
                 "text string, mask array<struct<start:long,end:long>>")


def count_tokens(text: str) -> int:
    """A size for budgets: pieces of up to six word characters, and single other characters."""
    return sum(1 for _ in _TOKEN.finditer(text))


def escape(text: str) -> str:
    """Breaks every ``<|`` by a backslash (one more if some are there), so that no control string is left."""
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn in the template, and where its text begins and ends."""
    head = START + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
    body = escape(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


def parse_window(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn of a formatted window, unescaped; offsets are of the escaped text."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn at {at}")
        line = text.index("\n", at)
        stop = text.index(END, line)
        role = _ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(text[at + len(START):line]))
        out.append((role, unescape(text[line + 1:stop]), line + 1, stop))
        at = stop + len(END) + 1
    return out


class _Formatter:
    """Streams the turns of one conversation and gives windows as they fill."""

    def __init__(self, conv: int | None, budget: int, history: int, size: Callable[[str], int]):
        self.conv, self.budget, self.history, self.size = conv, budget, history, size
        self.system: tuple | None = None
        self.new: list[tuple] = []        # turns of the open window
        self.tokens = 0                   # running sum of their sizes
        self.past: deque[tuple] = deque()  # the end of earlier windows, within the history budget
        self.past_tokens = 0
        self.window = 0
        self.turn = 0

    def add(self, role: str, text: str) -> Iterator[dict]:
        turn = (role, text, self.size(role) + self.size(text) + 3)
        room = self.budget - self.past_tokens - (self.system[2] if self.system else 0)
        if self.new and self.tokens + turn[2] > room:
            yield self.close()
        self.new.append(turn)
        self.tokens += turn[2]

    def close(self) -> dict:
        fixed = ([self.system] if self.system else []) + list(self.past)
        parts, mask, at = [], [], 0
        for i, (role, text, _) in enumerate(fixed + self.new):
            piece, a, b = format_turn(role, text)
            if i >= len(fixed) and role == "assistant":
                mask.append({"start": at + a, "end": at + b})
            parts.append(piece)
            at += len(piece)
        out = {"conv_id": self.conv, "window": self.window, "first_turn": self.turn, "n_turns": len(self.new),
               "n_repeated": len(fixed), "n_tokens": sum(t[2] for t in fixed + self.new), "text": "".join(parts), "mask": mask}
        new = self.new
        if self.window == 0 and new[0][0] == "system":
            self.system, new = new[0], new[1:]
        for t in new:  # the last turns that fit are repeated by the next window
            self.past.append(t)
            self.past_tokens += t[2]
        room = min(self.history, max(0, self.budget - (self.system[2] if self.system else 0)) // 2)
        while self.past and self.past_tokens > room:
            self.past_tokens -= self.past.popleft()[2]
        self.window, self.turn, self.new, self.tokens = self.window + 1, self.turn + len(self.new), [], 0
        return out


_ROWS = 256
_CHARS = 1 << 22


def format_windows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", budget: int = BUDGET, history: int = HISTORY,
                   size: Callable[[str], int] = count_tokens) -> DataFrame:
    """Windows of every conversation, in order within partitions: see WINDOW_SCHEMA.

    ``text`` is the formatted window, ``mask`` the spans of ``text`` that carry
    loss. A first turn of the role system is repeated at the start of each later
    window; ``n_repeated`` counts it and the repeated history. A turn larger
    than the budget has a window of its own (with what is repeated) and is never
    cut. Rows are ordered by turn (null first), ties by role and text, so
    repeated rows are turns of their own. Null roles and texts are empty; rows
    without a conversation form one conversation. Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("window", pa.int64()), ("first_turn", pa.int64()),
                            ("n_turns", pa.int64()), ("n_repeated", pa.int64()), ("n_tokens", pa.int64()),
                            ("text", pa.string()), ("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        out, chars = [], 0
        current: _Formatter | None = None
        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                done = []
                if current is None or conv != current.conv:
                    if current is not None and current.new:
                        done.append(current.close())
                    current = _Formatter(conv, budget, history, size)
                done.extend(current.add(role, text))
                for w in done:
                    out.append(w)
                    chars += len(w["text"])
                if len(out) >= _ROWS or chars >= _CHARS:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, chars = [], 0
        if current is not None and current.new:
            out.append(current.close())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                                F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, WINDOW_SCHEMA))


READ_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
               "formatted_chars long, n_windows long")


def read_windows(windows: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted windows alone (as ``format_windows`` orders them).

    Turns are read back from the template, repeated ones skipped, and digested
    as they stream by; so is the unescaped text under the loss mask.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                            ("n_windows", pa.int64())])
        state: list | None = None
        out = []

        def row(s: list) -> dict:
            return {"conv_id": s[0], "n_turns": s[1], "turns_sha256": s[2].hexdigest(), "loss_chars": s[3],
                    "loss_sha256": s[4].hexdigest(), "formatted_chars": s[5], "n_windows": s[6]}
        for batch in batches:
            for conv, repeated, text, mask in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        out.append(row(state))
                    state = [conv, 0, sha256(), 0, sha256(), 0, 0]
                for role, body, _, _ in parse_window(text)[repeated:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode())
                for span in mask:
                    loss = unescape(text[span["start"]:span["end"]])
                    state[3] += len(loss)
                    state[4].update(loss.encode())
                state[5] += len(text)
                state[6] += 1
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if state is not None:
            out.append(row(state))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return windows.select("conv_id", "n_repeated", "text", "mask").mapInArrow(run, READ_SCHEMA)
