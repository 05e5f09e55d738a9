"""Token counts by merging the pairs of many sequences at once in ragged numpy arrays.

All pieces of a batch lie one after the other as symbol numbers. In each round every sequence
merges all its occurrences of its own lowest-ranked pair; finished sequences leave. What is left of
a sequence is its number of tokens.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from surelake.llm.byte_bpe import as_characters, byte_characters
from surelake.llm.common import WordTable, cut_at_spaces, offsets_of, run_sums, small_batches

NEVER = np.iinfo(np.int64).max


def ranges(points: list[int]) -> str:
    """A character class body for sorted code points."""
    cut = np.flatnonzero(np.diff(points) != 1)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(np.array(points)[np.r_[0, cut + 1]], np.array(points)[np.r_[cut, len(points) - 1]]))


@cache
def piece_pattern() -> re.Pattern:
    """The byte-level pattern with the letters and digits that the tokenizers library knows.

    Unicode versions differ by library. Where two of them disagree on a character, the library's own
    pre-tokenizer is asked: a letter joins a letter before it, a digit a digit.
    """
    from tokenizers import pre_tokenizers

    alone = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    kind = {c: unicodedata.category(c)[0] for c in text}
    new = {name: set(regex.findall(rf"\p{{{name}}}", text)) for name in "LN"}
    for c in text:
        if (kind[c] == "L") != (c in new["L"]) or (kind[c] == "N") != (c in new["N"]):
            kind[c] = "L" if len(alone("a" + c)) == 1 else "N" if len(alone("1" + c)) == 1 else "other"
    letter, digit = (ranges([ord(c) for c in text if kind[c] == k]) for k in "LN")
    space = ranges(sorted(map(ord, regex.findall(r"\s", text))))
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+")


def supported(spec: dict) -> str:
    """What a vocabulary file has that the merger does not know; empty for a plain byte-level BPE."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    odd = [name for name, there in (
        ("a normalizer", spec.get("normalizer")), ("a model other than BPE", model.get("type", "BPE") != "BPE"),
        ("another pre-tokenizer than ByteLevel", pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space")),
        ("ignore_merges", model.get("ignore_merges")), ("dropout", model.get("dropout")), ("byte_fallback", model.get("byte_fallback")),
        ("a prefix or suffix of subwords", model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")),
        ("added tokens that strip or match words only", any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in spec["added_tokens"])),
    ) if there]
    return ", ".join(odd)


class Merger:
    """Merges of one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        unsupported = supported(spec)
        if unsupported:
            raise ValueError(f"{path}: not a plain byte-level BPE, it has {unsupported}")
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.of_byte = np.array([vocab[c] for c in byte_characters()], np.int64)
        self.width = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        self._fill(keys, np.array([vocab[a + b] for a, b in pairs], np.int64))

    def _fill(self, keys: np.ndarray, made: np.ndarray) -> None:
        """A hash table of rank and product per pair; a slot holds one pair, those left over get a further table."""
        self.tables = []
        ranks = np.arange(len(keys))
        while len(keys):
            slots = self._slot(keys)
            taken, first = np.unique(slots, return_index=True)
            table = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, np.int64), np.zeros(1 << 20, np.int32)
            table[0][taken], table[1][taken], table[2][taken] = keys[first], ranks[first], made[first]
            self.tables.append(table)
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, ranks, made = keys[left], ranks[left], made[left]

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left * self.width + right
        slots = self._slot(keys)
        rank, made = np.full(len(keys), NEVER), np.zeros(len(keys), np.int64)
        for table in self.tables:
            hit = table[0][slots] == keys
            rank[hit], made[hit] = table[1][slots[hit]], table[2][slots[hit]]
        return rank, made

    def counts(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece."""
        data = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        out = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(data), np.uint8)]
        which = np.repeat(np.arange(len(data)), lengths)
        while len(symbols) > 1:
            rank, made = self.ranked(symbols[:-1], symbols[1:])
            rank[which[:-1] != which[1:]] = NEVER
            rank = np.append(rank, NEVER)
            begins = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            size = np.diff(np.append(begins, len(symbols)))
            lowest = np.minimum.reduceat(rank, begins)
            out[which[begins]] = size
            hit = (rank == np.repeat(lowest, size)) & (rank != NEVER)
            # in a row of equal symbols every second pair counts, from the left
            before = np.append(False, hit[:-1])
            run_start = np.maximum.accumulate(np.where(hit & ~before, np.arange(len(hit)), 0))
            hit &= (np.arange(len(hit)) - run_start) % 2 == 0
            symbols = np.where(hit, np.append(made, 0), symbols)
            stays = ~np.append(False, hit[:-1]) & np.repeat(lowest != NEVER, size)
            symbols, which = symbols[stays], which[stays]
        out[which] = np.minimum(out[which], 1) if len(which) else out[which]
        return out


class Counter:
    def __init__(self, path: str):
        self.merger = Merger(path)
        self.piece = piece_pattern()
        self.special = re.compile("|".join(map(re.escape, self.merger.special))) if self.merger.special else None
        self.pieces = WordTable(lambda w: (self.merger.counts(w), np.zeros(0, np.int8)), np.int8)
        self.chunks = WordTable(self._count_chunks, np.int8)

    def _count_chunks(self, chunks: list[str]):
        split = []
        marks = np.zeros(len(chunks), np.int64)
        for n, chunk in enumerate(chunks):
            if self.special and (found := len(self.special.findall(chunk))):
                marks[n] = found
                split.append([p for part in self.special.split(chunk) for p in self.piece.findall(part)])
            else:
                split.append(self.piece.findall(chunk))
        picked = self.pieces.slots([p for s in split for p in s])
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        return marks + run_sums(self.pieces.lengths[picked], sizes), np.zeros(0, np.int8)

    def count(self, texts: pa.Array) -> np.ndarray:
        slots, per_text = cut_at_spaces(pc.fill_null(texts, ""), self.chunks)
        return run_sums(self.chunks.lengths[slots], per_text)


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens), as the library counts them.

    A special token written in a text is one token, as the library has it. A null or empty text has no
    tokens. One row per input row, repeated rows and null ids included; an empty table gives no rows;
    other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in small_batches(batches, "text"):
            n = own.count(batch.column("text"))
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    given = docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text")
    return given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
