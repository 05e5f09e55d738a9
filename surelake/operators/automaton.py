"""Many needles in one pass over the texts: a keyword automaton as flat arrays, run over batches of texts.

All texts of a batch step through the automaton together, a character each; long ones are cut into pieces that overlap by
the longest needle. Nothing is gathered per character pair, so texts are read once and only hits leave the task.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from .overlap import containing

#: Characters of a long text that one lane steps through, besides the overlap.
PIECE = 1024


class Automaton:
    """Trie of the needles with the longest shorter match of every state; a transition is looked up among sorted keys."""

    def __init__(self, needles: list[str]):
        self.needles = needles
        self.letters = np.array(sorted({ord(c) for n in needles for c in n}), np.uint32)
        number = {int(c): k for k, c in enumerate(self.letters)}
        self.width = len(number) + 1
        self.longest = max(map(len, needles), default=0)
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for n, needle in enumerate(needles):
            state = 0
            for c in needle:
                k = number[ord(c)]
                if k not in children[state]:
                    children[state][k] = len(children)
                    children.append({})
                    ends.append(-1)
                state = children[state][k]
            ends[state] = n
        fail, link = [0] * len(children), [0] * len(children)
        queue = deque(children[0].values())
        while queue:
            state = queue.popleft()
            for k, to in children[state].items():
                back = fail[state]
                while back and k not in children[back]:
                    back = fail[back]
                fail[to] = children[back][k] if k in children[back] and children[back][k] != to else 0
                link[to] = fail[to] if ends[fail[to]] >= 0 else link[fail[to]]
                queue.append(to)
        edges = sorted((state * self.width + k, to) for state, own in enumerate(children) for k, to in own.items())
        self.keys, self.to = (np.array(c, np.int64) for c in (zip(*edges) if edges else ((), ())))
        self.fail, self.link, self.ends = (np.array(c, np.int64) for c in (fail, link, ends))
        self.tells = (self.ends >= 0) | (self.link > 0)

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Next states; ``letter`` is the number of a needles' letter, or the last number for any other."""
        out = np.zeros(len(state), np.int64)
        open_ = np.flatnonzero(letter < self.width - 1)
        state, letter = state[open_], letter[open_]
        while len(open_):
            key = state * self.width + letter
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            out[open_[found]] = self.to[at[found]]
            rest = ~found & (state > 0)
            open_, state, letter = open_[rest], self.fail[state[rest]], letter[rest]
        return out

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, needle) of all needles in all texts, each pair once."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not self.longest or not len(texts):
            return none
        values = [t or "" for t in texts.to_pylist()]
        codes = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            return none
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        letter = np.where(self.letters[at] == codes, at, self.width - 1)
        length = np.array([len(v) for v in values])
        lanes = np.maximum(1, -(-length // PIECE))
        text = np.repeat(np.arange(len(values)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = np.repeat(np.cumsum(length) - length, lanes)
        end = first + np.minimum(length[text], (nth + 1) * PIECE + self.longest - 1)
        start = first + nth * PIECE
        order = np.argsort(start - end, kind="stable")  # the longest first, so that those still running stand in front
        start, end, text = start[order], end[order], text[order]
        running = len(start)
        state = np.zeros(running, np.int64)
        found = [none]
        for j in range(int((end - start).max(initial=0))):
            running = int(np.searchsorted(-(end - start)[:running], -j, "left"))
            state = self.step(state[:running], letter[start[:running] + j])
            told = np.flatnonzero(self.tells[state])
            if len(told):
                found.append((text[told], state[told]))
        text, state = (np.concatenate(c) for c in zip(*found))
        pairs = np.unique(text * len(self.ends) + state)
        text, state = pairs // len(self.ends), pairs % len(self.ends)
        out = []
        while len(text):  # shorter needles that end where a longer one does
            whole = self.ends[state] >= 0
            out.append(text[whole] * len(self.needles) + self.ends[state[whole]])
            state = self.link[state]
            text, state = text[state > 0], state[state > 0]
        pairs = np.unique(np.concatenate(out)) if out else none[0]
        return pairs // len(self.needles), pairs % len(self.needles)


def containing_once(needles: DataFrame, texts: DataFrame, group: list[str] | None = None, most_letters: int = 2_000_000) -> DataFrame:
    """Pairs (qid, kid) where the text contains the needle, as ``overlap.containing`` gives them, by one pass over the texts.

    ``needles``: qid, needle. ``texts``: kid, text. Only those of one ``group`` meet. Null and empty needles and texts have no pairs. Needles of more than
    ``most_letters`` characters together, which every task would have to hold, are searched by ``overlap.containing``.
    """
    group = group or []
    spark = texts.sparkSession
    asked = needles.where(F.length("needle") > 0)
    known = asked.select("needle").distinct()
    if (known.agg(F.sum(F.length("needle"))).first()[0] or 0) > most_letters:
        return containing(asked, texts, group)
    table = spark.sparkContext.broadcast(Automaton([r.needle for r in known.orderBy("needle").collect()]))
    given = texts.where(F.length("text") > 0).select("kid", *group, "text")
    told = StructType([*given.drop("text").schema.fields, StructField("needle", StringType())])
    schema = to_arrow_schema(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, 500) for a in range(0, batch.num_rows, 500)):
                text, needle = table.value.hits(part.column("text"))
                rows = part.take(pa.array(text))
                names = pa.array(table.value.needles, pa.string()).take(pa.array(needle))
                yield pa.RecordBatch.from_arrays([*[rows.column(c).cast(schema.field(c).type) for c in ("kid", *group)], names], names=schema.names)

    return given.mapInArrow(run, told).join(asked.select("qid", *group, "needle").distinct(), [*group, "needle"]).select("qid", "kid")
