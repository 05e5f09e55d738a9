"""Packing along a space-filling curve.

The token counts of a document, hashed and projected to a few dimensions, give a point; the points are
ordered by their Hilbert key, so that documents with like words lie near each other on the curve. Sampled
splitters cut the curve into ranges of like size, and each range is packed in order: tokens flow on from
document to document and are cut every ``room`` tokens. The last tokens of a range go into sequences
of powers of two, which need no padding.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from surelake.llm.byte_bpe import as_characters
from surelake.llm.common import WordTable, coded, list_lengths, offsets_of, run_sums, shuffle_partitions, small_batches

HASHED, DIMS, BITS = 1024, 4, 12
#: Latin letters, and ASCII marks but for the apostrophe.
LETTERS, MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", r"[!-&(-/:-@\[-`{-~]"
#: Letters in lower case that neither the normalizer nor the pre-tokenizer changes or parts.
PLAIN = re.compile("[a-zß-öø-ÿ]+")


def trimmed(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words as a stem and a tail whose tokens follow each other.

    The tokenizer parts a run of letters from the run of marks after it, and lowers letters. So Latin letters
    with only ASCII marks after them, none an apostrophe, become a stem in lower case and a tail; any
    other word is a stem as it is.
    """
    both = pc.match_substring_regex(words, f"^{LETTERS}{MARKS}*$")
    stems = pc.if_else(both, pc.utf8_lower(pc.replace_substring_regex(words, f"{MARKS}+$", "")), words)
    return stems, pc.if_else(both, pc.replace_substring_regex(words, f"^{LETTERS}", ""), "")


class Ids:
    """Token ids of whole texts by the tokenizers library, each different word encoded once.

    White space parts the tokenizer's pieces, so a text's ids are those of its words in turn. A word of plain
    lower-case letters passes its normalizer and pre-tokenizer as one piece and goes to its BPE model directly.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.merged = self.model.model.tokenize
        self.stems = WordTable(self._encode, np.uint32, limit=200_000)

    def _encode(self, words: list[str]):
        found = [[t.id for t in self.merged(w if w.isascii() else as_characters(w.encode()))] if PLAIN.fullmatch(w) else None for w in words]
        other = iter(self.model.encode_batch_fast([w for w, ids in zip(words, found) if ids is None], add_special_tokens=False))
        found = [next(other).ids if ids is None else ids for ids in found]
        return np.fromiter(map(len, found), np.int64, len(found)), np.array([i for ids in found for i in ids], np.uint32)

    def encode(self, texts: pa.Array, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text and ``last`` after them: how many, all ids)."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        parts = pa.concat_arrays(trimmed(words.dictionary))
        index, known = coded(parts)
        pair = self.stems.slots(known)[index].reshape(2, -1)[:, words.indices]  # stem and tail of each word
        per_text = run_sums(self.stems.lengths[pair].sum(axis=0), list_lengths(split))
        ids = self.stems.take(pair.T.ravel())
        ends = np.cumsum(per_text + 1)
        out = np.full(ends[-1] if len(ends) else 0, last, np.uint32)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        out[inner] = ids
        return per_text + 1, out


@cache
def tokenizer(path: str) -> Ids:
    return Ids(path)


def projection() -> np.ndarray:
    return np.random.default_rng(11).standard_normal((HASHED, DIMS)) / np.sqrt(HASHED)


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Places on the Hilbert curve of grid points, one row each with ``BITS`` bits per dimension."""
    x = points.astype(np.int64).T.copy()
    q = 1 << (BITS - 1)
    while q > 1:  # undo the turns and mirrorings of the curve, from the largest cell down
        low = q - 1
        for i in range(DIMS):
            mirrored = (x[i] & q) > 0
            swap = np.where(mirrored, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(mirrored, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, DIMS):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (BITS - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    key = np.zeros_like(turn)
    for bit in range(BITS - 1, -1, -1):
        for i in range(DIMS):
            key = key << 1 | ((x[i] ^ turn) >> bit & 1)
    return key


def curve_keys(counts: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Hilbert key of each document from its token ids."""
    bins = (ids.astype(np.int64) * 40503 >> 4) % HASHED
    hashed = np.zeros((len(counts), HASHED))
    ends = np.cumsum(counts)
    for n, (a, b) in enumerate(zip(ends - counts, ends)):
        hashed[n] = np.bincount(bins[a:b], minlength=HASHED)
    points = np.sqrt(hashed / np.maximum(counts, 1)[:, None]) @ projection() * np.sqrt(HASHED)
    return hilbert_keys(np.clip((np.tanh(points) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1))


def keyed(docs: DataFrame, path: str, last: int, with_ids: bool, splitters=None) -> DataFrame:
    """doc_id, curve, and with ``with_ids`` the ids (two bytes each where they fit) and the range of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        wide = own.model.get_vocab_size() > 65536 or last > 65535
        for batch in small_batches(batches, "text", 4 << 20):
            counts, ids = own.encode(batch.column("text"), last)
            curve = curve_keys(counts, ids)
            columns, names = [batch.column("doc_id"), pa.array(curve, pa.int64())], ["doc_id", "curve"]
            if with_ids:
                key = curve * 1024 + batch.column("spread").to_numpy()
                data, width = (ids.astype("<u4"), 4) if wide else (ids.astype("<u2"), 2)
                raw, at = data.tobytes(), offsets_of(counts) * width
                packed = pa.array([raw[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary())
                columns += [packed, pa.array([width] * len(counts), pa.int32()), pa.array(np.searchsorted(splitters.value, key, "right"), pa.int32())]
                names += ["ids", "width", "part"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, curve long" + (", ids binary, width int, part int" if with_ids else ""))


class Filler:
    """Sequences of one task: gapless, full but for the last tokens, which fill powers of two."""

    def __init__(self, task: int, room: int):
        self.room, self.next, self.at, self.open = room, task << 40, 0, []

    def add(self, doc: int, ids: np.ndarray) -> list[tuple]:
        """Pieces of one document of sequences now full: (doc, start, ids, doc tokens, sequence, offset)."""
        start, done = 0, []
        while start < len(ids):
            n = min(self.room - self.at, len(ids) - start)
            self.open.append((doc, start, ids[start : start + n], len(ids)))
            self.at += n
            start += n
            if self.at == self.room:
                done += self._close(self.room)
        return done

    def _close(self, size: int) -> list[tuple]:
        """The first ``size`` open tokens as one sequence."""
        done, offset, rest = [], 0, []
        for doc, start, ids, total in self.open:
            n = min(size - offset, len(ids))
            if n:
                done.append((doc, start, ids[:n], total, self.next, offset))
                offset += n
            if n < len(ids):
                rest.append((doc, start + n, ids[n:], total))
        self.open, self.at, self.next = rest, self.at - size, self.next + 1
        return done

    def finish(self) -> list[tuple]:
        done = []
        while self.at:
            done += self._close(1 << (self.at.bit_length() - 1))
        return done


def pack(
    docs: DataFrame, path: str, room: int = 4096, last: int = 2, doc_id: str = "doc_id", text: str = "text", range_bytes: int = 64 << 20, sample_per_range: int = 60, most_ranges: int = 20_000
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``room`` is a power of two. Every document ends in the id ``last``; a null or empty text is that id alone. Ids
    are cut freely, each lies in one piece. Repeated rows and null ids are documents of their own; equal
    documents have one key and are spread over ranges by a hash of the id. An empty table gives no rows;
    other columns are not read. The driver holds ``sample_per_range`` keys for each of at most
    ``most_ranges`` ranges.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, size = given.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    ranges = min(most_ranges, max(shuffle_partitions(spark), -(-size // range_bytes)))
    share = min(1.0, ranges * sample_per_range / max(rows, 1))
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1024))
    sampled = keyed(given.sample(False, share, 5) if share < 1 else given, path, last, False).select((F.col("curve") * 1024 + spread).alias("key"))
    keys = np.sort(np.array([r.key for r in sampled.collect()], np.int64))
    cuts = np.unique(keys[len(keys) * np.arange(1, ranges) // ranges]) if len(keys) else keys
    splitters = spark.sparkContext.broadcast(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filler = Filler(TaskContext.get().partitionId(), room)
        for batch in batches:
            done = []
            for doc, raw, width in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("width").to_pylist()):
                done += filler.add(doc, np.frombuffer(raw.as_buffer(), f"<u{width}"))
            yield rows_of(done)
        yield rows_of(filler.finish())

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        parts = list(zip(*done)) if done else [()] * 6
        crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in parts[2]]
        columns = [pa.array(parts[0], doc_type), *(pa.array(c, pa.int64()) for c in (parts[1], [len(i) for i in parts[2]], crc, parts[3], parts[4], parts[5]))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    doc_type = to_arrow_type(given.schema["doc_id"].dataType)
    placed = keyed(given.withColumn("spread", spread), path, last, True, splitters)
    ordered = placed.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("curve", "doc_id")
    kind = given.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
