"""Conversations as training windows within a token budget.

Prefix sums over the tokens of the turns choose spans of whole turns. Each window repeats the system turn
and some of the turns just before its span, then holds the span. The loss mask covers the assistant
texts of the span, never those repeated as history, so every target is learned from once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surelake.llm.common import small_batches

#: The template: a turn is ``### `` role ``: `` text ``</turn>`` and a line feed.
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
#: Control strings inside a role or text, and what stands for them; the backslash marks what was replaced.
ESCAPES = (("\\", "\\\\"), ("###", "\\h"), ("</turn>", "\\t"), (": ", "\\c"))
TURN = re.compile(r"### (.*?): (.*?)</turn>\n", re.S)


def escaped(text: str) -> str:
    for plain, written in ESCAPES:
        text = text.replace(plain, written)
    return text


def unescaped(text: str) -> str:
    back = {written[1]: plain for plain, written in ESCAPES}
    return re.sub(r"\\(.)", lambda m: back[m.group(1)], text, flags=re.S)


def formatted(role: str, text: str) -> str:
    return OPEN + escaped(role) + BETWEEN + escaped(text) + CLOSE


def guessed(turns: list[str]) -> list[int]:
    """Cost of formatted turns without a tokenizer: words, or a quarter of the characters if more."""
    return [max(len(t.split()), -(-len(t) // 4)) for t in turns]


@cache
def counter(path: str | None):
    """A function that gives the tokens of formatted turns, by the tokenizer in a file of the tokenizers library."""
    if path is None:
        return guessed
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda turns: [len(e.ids) for e in model.encode_batch_fast(turns, add_special_tokens=False)]


class Windows:
    """Windows of one conversation, turn by turn; holds one window and the history at most. A turn is (role, text, tokens)."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple[str, str, int] | None = None
        self.lead: list[tuple[str, str, int]] = []
        self.past: list[tuple[str, str, int]] = []
        self.span: list[tuple[str, str, int]] = []
        self.spent = 0
        self.started = self.first_done = False

    def add(self, role: str, text: str, cost: int) -> list[tuple[str, list, int]]:
        done = []
        if not self.started and role == "system":
            self.system = (role, text, cost)
        if self.span and self.spent + cost > self.budget:
            done.append(self._window())
        if not self.span:  # what is repeated gives way to the turn: history first, the oldest first, then the system turn
            self.lead = [self.system] if self.system and self.first_done else []
            self.spent = sum(t[2] for t in self.lead + self.past)
            while self.past and self.spent + cost > self.budget:
                self.spent -= self.past.pop(0)[2]
            if self.spent + cost > self.budget:
                self.lead, self.spent = [], 0
        self.started = True
        self.span.append((role, text, cost))
        self.spent += cost
        return done

    def finish(self) -> list[tuple[str, list, int]]:
        return [self._window()] if self.span else []

    def _window(self) -> tuple[str, list, int]:
        """(formatted text, loss spans in characters, repeated turns), then history for the next one."""
        repeated = self.lead + self.past
        text, mask = [], []
        at = 0
        for n, (role, said, _) in enumerate(repeated + self.span):
            head, body = OPEN + escaped(role) + BETWEEN, escaped(said)
            if n >= len(repeated) and role == "assistant":
                mask.append((at + len(head), at + len(head) + len(body)))
            text += [head, body, CLOSE]
            at += len(head) + len(body) + len(CLOSE)
        out = ("".join(text), mask, len(repeated))
        turns, self.past, room = self.past + self.span, [], self.history
        for turn in reversed(turns):
            if turn == self.system or turn[2] > room:
                break
            room -= turn[2]
            self.past.insert(0, turn)
        self.span, self.first_done = [], True
        return out


def parsed(window: str) -> list[tuple[str, str]]:
    """Turns read back from a formatted window."""
    return [(unescaped(role), unescaped(text)) for role, text in TURN.findall(window)]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Turns with all of a conversation in one task, in order; ties on the turn by role, then text."""
    given = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return given.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def conversation_windows(batches: Iterator[pa.RecordBatch], budget: int, history: int, tokenizer: str | None):
    """(conv_id, is last, windows) as the rows stream by; no conversation is held whole."""
    now, open_ = None, None
    costs = counter(tokenizer)
    for batch in small_batches(batches, "text"):
        convs, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
        for conv, role, text, cost in zip(convs, roles, texts, costs([formatted(r, t) for r, t in zip(roles, texts)])):
            if open_ is None or conv != now:
                if open_ is not None:
                    yield now, True, open_.finish()
                now, open_ = conv, Windows(budget, history)
            if done := open_.add(role, text, cost):
                yield now, False, done
    if open_ is not None:
        yield now, True, open_.finish()


def format_windows(conversations: DataFrame, budget: int = 2048, history: int = 256, tokenizer: str | None = None) -> DataFrame:
    """conv_id, window (from 0), text, loss_starts, loss_ends (characters), repeated (turns that are history).

    ``budget`` and ``history`` are tokens of formatted turns by ``tokenizer``, a file of the tokenizers library (a guess without one). No window
    is above the budget, unless a single turn is, which is never cut and stands alone. A null role or text is
    empty; a null conv_id is a conversation of its own; turns with one number come by role, then text, repeated rows are turns of
    their own. An empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before, rows = 0, None, []
        for conv, last, windows in conversation_windows(batches, budget, history, tokenizer):
            for text, mask, repeated in windows:
                rows.append((conv, number, text, [a for a, _ in mask], [b for _, b in mask], repeated))
                number += 1
            number = 0 if last else number
            if len(rows) >= 200:
                yield batch_of(rows)
                rows = []
        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * 6
        types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
        names = ["conv_id", "window", "text", "loss_starts", "loss_ends", "repeated"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    turns = ordered_turns(conversations).withColumn("conv_id", F.col("conv_id").cast("long"))
    return turns.mapInArrow(run, "conv_id long, window long, text string, loss_starts array<long>, loss_ends array<long>, repeated long")


class Digest:
    """What a conversation's windows say when read back, as sums and running hashes."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def read(self, window: str, mask: list[tuple[int, int]], repeated: int) -> None:
        self.chars += len(window)
        for role, text in parsed(window)[repeated:]:
            self.turns += 1
            self.turn_hash.update(f"{role}\n{text}\n".encode())
        for a, b in mask:
            plain = unescaped(window[a:b])
            self.loss_chars += len(plain)
            self.loss_hash.update(plain.encode())

    def row(self) -> tuple:
        return self.turns, self.turn_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


def window_digests(conversations: DataFrame, budget: int = 2048, history: int = 256, tokenizer: str | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the windows.

    The hashes run over a conversation's turns in order, so its turns stream through one task; no more than
    a window of them is held at a time. Nulls, ties, repeated rows, long texts and empty tables as in ``format_windows``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, digest = [], Digest()
        for conv, last, windows in conversation_windows(batches, budget, history, tokenizer):
            for window in windows:
                digest.read(*window)
            if last:
                rows.append((conv, *digest.row()))
                digest = Digest()
            if len(rows) >= 2000:
                yield batch_of(rows)
                rows = []
        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * 6
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    turns = ordered_turns(conversations).withColumn("conv_id", F.col("conv_id").cast("long"))
    return turns.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
