"""Helpers that several operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the documents that no label is learned from; a null id is read as the word ``null``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")) % 5 == 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def small_batches(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most_bytes`` of text, one row at least."""
    for batch in batches:
        sizes = np.cumsum(text_lengths(batch.column(text)))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + most_bytes, "right")))
            yield batch.slice(start, end - start)
            start = end


def text_lengths(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text, null as 0."""
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def ragged_take(starts: np.ndarray, lengths: np.ndarray, flat: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[p] : starts[p] + lengths[p]]`` of all picked rows, one after the other."""
    n = lengths[picked]
    ends = np.cumsum(n)
    where = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) + np.repeat(starts[picked] - (ends - n), n)
    return flat[where]


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


class WordTable:
    """What a function gives for each word, kept while a worker lives, up to ``limit`` words.

    ``many(words)`` returns (lengths, flat values). The table is only a memory of earlier
    answers: it starts anew when full, results do not depend on it.
    """

    def __init__(self, many, dtype, limit: int = 500_000, most_chars: int = 24_000_000):
        self.many, self.dtype, self.limit, self.most_chars = many, dtype, limit, most_chars
        self.reset()

    def reset(self) -> None:
        self.slot: dict[str, int] = {}
        self.chars = 0
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def slots(self, words: list[str]) -> np.ndarray:
        if len(self.slot) > self.limit or self.chars > self.most_chars:
            self.reset()
        missing = [w for w in dict.fromkeys(words) if w not in self.slot]
        if missing:
            lengths, flat = self.many(missing)
            first = len(self.slot)
            self.chars += sum(map(len, missing))
            self.slot.update(zip(missing, range(first, first + len(missing))))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, flat.astype(self.dtype)])
        return np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))

    def take(self, picked: np.ndarray) -> np.ndarray:
        return ragged_take(self.starts, self.lengths, self.flat, picked)


def coded(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Words as numbers into the list of different words."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary.to_numpy(zero_copy_only=False).tolist()


def list_lengths(lists: pa.Array) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)


def run_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` values."""
    sums, ends = offsets_of(values), np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def cut_at_spaces(texts: pa.Array, known: WordTable) -> tuple[np.ndarray, np.ndarray]:
    """Slots of ``known`` for the chunks of all texts, and how many each text has.

    A single space between two characters that are not white space begins a piece of the byte-level
    patterns, so texts are cut there and equal chunks are looked up once. A text with a space
    beside other white space, or at its edge, is one chunk.
    """
    parts = pc.split_pattern(texts, " ")
    index, words = coded(parts.flatten())
    per_text = list_lengths(parts)
    firsts = np.cumsum(per_text) - per_text
    if not len(texts):
        return np.zeros(0, np.int64), per_text
    unsafe = np.array([not w or w[0].isspace() or w[-1].isspace() for w in words], bool)
    whole = np.logical_or.reduceat(unsafe[index], firsts)
    uncut = texts.filter(pa.array(whole)).to_pylist()
    slots = known.slots([" " + w for w in words] + [words[i] for i in index[firsts]] + uncut)
    out = slots[: len(words)][index]
    out[firsts] = slots[len(words) : len(words) + len(firsts)]
    out[firsts[whole]] = slots[len(words) + len(firsts) :]
    stays = np.ones(len(out), bool)
    stays[np.repeat(whole, per_text)] = False
    stays[firsts] = True
    return out[stays], np.where(whole, 1, per_text)
