"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

The library works on characters, so each byte is written as one printable character. A vocabulary
of byte strings with ranks is turned into the library's vocabulary and merges: the merge that makes
a token is the last pair left when the token is merged by the lower ranks alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from surelake.llm.common import WordTable, cut_at_spaces, offsets_of, run_sums, small_batches


@cache
def byte_characters() -> list[str]:
    """Printable Latin-1 bytes stand for themselves, the others for the characters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


def as_characters(data: bytes) -> str:
    signs = byte_characters()
    return "".join([signs[b] for b in data])


def as_bytes(signs: str) -> bytes:
    back = {c: b for b, c in enumerate(byte_characters())}
    return bytes(back[c] for c in signs)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The parts left when only merges of a lower rank than the token's own are done."""
    parts, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
        if rank >= own:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


@cache
def library(path: str):
    """The tokenizers model with the ranks of a file. A whole piece that is a token is taken as it is."""
    from tokenizers import Tokenizer, models

    ranks = read_ranks(path)
    merges = []
    for token in sorted(ranks, key=ranks.get):
        parts = last_pair(token, ranks) if len(token) > 1 else [token]
        if len(parts) == 2:
            merges.append((as_characters(parts[0]), as_characters(parts[1])))
    vocab = {as_characters(t): r for t, r in ranks.items()}
    return Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))


class Codec:
    """Encoder and decoder for one vocabulary file and piece pattern."""

    def __init__(self, path: str, pattern: str):
        self.model = library(path)
        self.piece = regex.compile(pattern)
        ranks = read_ranks(path)
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        self.decimal = [str(i) for i in range(len(self.token_bytes))]
        self.pieces = WordTable(self._encode_pieces, np.int32)
        self.chunks = WordTable(self._encode_chunks, np.int32)

    def _encode_pieces(self, pieces: list[str]):
        found = [e.ids for e in self.model.encode_batch_fast([as_characters(p.encode()) for p in pieces], add_special_tokens=False)]
        return np.fromiter(map(len, found), np.int64, len(found)), np.array([i for ids in found for i in ids], np.int32)

    def _encode_chunks(self, chunks: list[str]):
        split = [self.piece.findall(c) for c in chunks]
        picked = self.pieces.slots([p for s in split for p in s])
        counts = np.fromiter(map(len, split), np.int64, len(split))
        return run_sums(self.pieces.lengths[picked], counts), self.pieces.take(picked)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of each text, all ids). Null counts as empty."""
        slots, per_text = cut_at_spaces(pc.fill_null(texts, ""), self.chunks)
        return run_sums(self.chunks.lengths[slots], per_text), self.chunks.take(slots)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids; a character cut between two tokens comes together again."""
        table = self.token_bytes
        return b"".join([table[i] for i in ids])

    def offsets(self, text: str, ids: list[int]) -> list[tuple[int, int]]:
        """First and last + 1 character of each token; a token inside a character points at that character."""
        data = np.frombuffer(text.encode(), np.uint8)
        char_at = np.append(np.cumsum((data & 0xC0) != 0x80) - 1, len(text))
        ends = np.cumsum([len(self.token_bytes[i]) for i in ids]).astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        return [(int(char_at[s]), int(char_at[e - 1]) + 1) for s, e in zip(starts, ends)]


@cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array<int>, starts and ends array<int>: characters each token covers. Null text: no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in small_batches(batches, "text"):
            counts, ids = own.encode(batch.column("text"))
            ends = offsets_of(counts)
            rows = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
            spans = [own.offsets(t or "", i) if i else [] for t, i in zip(batch.column("text").to_pylist(), rows)]
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (rows, [[a for a, _ in s] for s in spans], [[b for _, b in s] for s in spans])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "ids", "starts", "ends"])

    given = docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text")
    return given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text. Null ids: the empty text. Bytes that are no UTF-8 (ids cut inside a character) become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = [own.decode(i or []).decode("utf-8", "replace") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    given = encoded.selectExpr(f"`{doc_id}` AS doc_id", f"`{ids}` AS ids")
    return given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one space), decoded_sha256 (bytes the ids decode to).

    A null or empty text has no tokens and the digests of the empty string. One output row per input row,
    repeated rows and null ids included; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in small_batches(batches, "text"):
            counts, ids = own.encode(batch.column("text"))
            ends = offsets_of(counts)
            id_hash, text_hash = [], []
            for a, b in zip(ends[:-1], ends[1:]):
                row = ids[a:b].tolist()
                id_hash.append(hashlib.sha256(" ".join([own.decimal[i] for i in row]).encode()).hexdigest())
                text_hash.append(hashlib.sha256(own.decode(row)).hexdigest())
            out = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_hash, pa.string()), pa.array(text_hash, pa.string())]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    given = docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text")
    return given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
