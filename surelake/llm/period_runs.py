"""Periodic runs of words by a dictionary of basic factors.

Every stretch of 1, 2, 4, 8, ... words of a document gets a number, equal stretches the same one, each
length named from pairs of the length before. A run of smallest period q holds two occurrences of its
first L words at distance q, where L is the power of two with L <= q < 2 L. So, for each length L, equal
stretches at distances from L to 2 L propose periods. Occurrences that follow each other within L / 2
stand in an arithmetic progression; of such a progression only the two ends look for partners, which
find every run (a run's pair of inner elements moves along to a pair with an end, or the whole run has
the progression's smaller period). Proposals are extended both ways by the numbered stretches, largest
first, and equal runs are merged, the smallest period kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surelake.llm.common import list_lengths, offsets_of, run_sums, small_batches, text_of

#: Shorter runs are not reported; it must be at least twice ``FIRST`` plus its half, so that every period under 2 FIRST is seen at FIRST.
LEAST = 12
#: The shortest stretch that proposes periods.
FIRST = 4


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(number of each word, words per text, the different words). White space is space and \\t to \\r."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = ~pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0, bool)
    return codes[real], run_sums(real.astype(np.int64), list_lengths(split)), coded.dictionary


class Factors:
    """Numbers of the stretches of 1, 2, 4, ... words at every place, within the bounds of the sequences."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.n = len(codes)
        ends = np.cumsum(counts)
        self.begin, self.end = np.repeat(ends - counts, counts), np.repeat(ends, counts)
        own = np.repeat(np.arange(len(counts)), counts)
        self.names = {1: codes}
        #: Places of each length whose stretch occurs again in the same sequence, by number and place.
        self.again: dict[int, np.ndarray] = {}
        places, size = np.arange(self.n), 1
        while len(places):
            places = places[places + 2 * size <= self.end[places]]
            names = self.names[size]
            left, right = names[places], names[places + size]
            if size == FIRST // 2:  # from here on, stretches of different sequences differ
                left = left + own[places] * (2 * self.n + 2)
            pairs, number, many = np.unique(left * (2 * self.n + 2) + right, return_inverse=True, return_counts=True)
            size *= 2
            named = np.arange(self.n, 2 * self.n)  # a stretch that occurs once has a number of its own
            named[places] = np.where(many[number] > 1, number, named[places])
            self.names[size] = named
            if size >= FIRST:
                places = places[many[number] > 1]
                self.again[size] = places[np.argsort(named[places], kind="stable")]

    def extend(self, a: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The widest stretches around ``a`` to ``a + q`` whose words ``q`` apart are equal, as (start, end)."""
        low, high = a.copy(), a + q
        begin, end = self.begin[a], self.end[a]
        sizes = [s for s in sorted(self.names, reverse=True) if s >= FIRST] + [1] * (FIRST - 1)
        for size in sizes:
            names = self.names[size]
            fits = (high + size <= end) & (high < self.n)
            fits[fits] = names[high[fits] - q[fits]] == names[high[fits]]
            high += size * fits
        for size in sizes:
            names = self.names[size]
            fits = low - size >= begin
            fits[fits] = names[low[fits] - size] == names[low[fits] - size + q[fits]]
            low -= size * fits
        return low, high


def proposals(factors: Factors) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs that together touch every run of at least ``LEAST`` words."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for size, at in factors.again.items():
        if not len(at):
            continue
        names = factors.names[size][at]
        if size == FIRST:  # all pairs nearer than 2 FIRST, at most 2 FIRST - 1 hops
            for hop in range(1, min(2 * FIRST, len(at))):
                near = (names[hop:] == names[:-hop]) & (at[hop:] - at[:-hop] < 2 * FIRST)
                found.append((at[:-hop][near], (at[hop:] - at[:-hop])[near]))
            continue
        linked = (names[1:] == names[:-1]) & (at[1:] - at[:-1] <= size // 2)
        first, last = np.concatenate([[True], ~linked]), np.concatenate([~linked, [True]])
        progression = np.cumsum(first)
        points = np.flatnonzero(first | last)
        key = names * (2 * factors.n + 2) + at  # sorted
        for low, high in ((size, 2 * size), (-2 * size + 1, -size + 1)):
            a = np.searchsorted(key, key[points] + low)
            b = np.searchsorted(key, key[points] + high)
            n = np.maximum(b - a, 0)
            x = np.repeat(points, n)
            y = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
            ok = (names[x] == names[y]) & (progression[x] != progression[y])
            x, y = at[x[ok]], at[y[ok]]
            found.append((np.minimum(x, y), np.abs(x - y)))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(codes: np.ndarray, counts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all maximal runs of all sequences, by start and period, as places in ``codes``."""
    factors = Factors(codes, counts)
    place, period = proposals(factors)
    # one proposal of those that stand next to each other with one period, as they extend to one run
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    fresh = np.ones(len(place), bool)
    fresh[1:] = (period[1:] != period[:-1]) | (place[1:] != place[:-1] + 1) | (factors.begin[place[1:]] != factors.begin[place[:-1]])
    place, period = place[fresh], period[fresh]
    start, end = factors.extend(place, period)
    whole = end - start >= np.maximum(least, 2 * period)
    start, end, period = start[whole], end[whole], period[whole]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[fresh], end[fresh], period[fresh]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def kept_words(n: int, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """False for words that some run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:-1]) == 0


def repeated_tails(doc_ids: list, counts: np.ndarray) -> np.ndarray:
    """Places of the words that texts have after the tails of a tenth of them, chosen by the id's checksum, are made periodic.

    With h the CRC-32 of the decimal id (``null`` for a null id), g = h // 10 and n words, a text with 10 | h repeats from word
    a = g % n on its words a to a + p - 1, where p = 1 + (n - a) // (3 + g % 8).
    """
    at = np.arange(counts.sum())
    starts = offsets_of(counts)
    for k, (doc, n) in enumerate(zip(doc_ids, counts.tolist())):
        h = zlib.crc32(b"null" if doc is None else str(doc).encode())
        if n and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            tail = starts[k] + a
            at[tail : starts[k] + n] = tail + np.arange(n - a) % p
    return at


def _read(batches: Iterator[pa.RecordBatch], planted: bool):
    """Of each small batch: its ids, word numbers, words per text, the words, and all runs."""
    for batch in small_batches(batches, "text", 4 << 20):
        codes, counts, words = words_of(batch.column("text"))
        if planted:
            codes = codes[repeated_tails(batch.column("doc_id").to_pylist(), counts)]
        yield batch.column("doc_id"), codes, counts, words, runs_of(codes, counts)


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per run: doc_id, start (word number), length, period, in words.

    A run has a smallest period q, at least ``LEAST`` and 2 q words, and cannot be made longer. Null, empty and short texts have
    none; texts are read whole, each in one task; repeated rows are documents of their own. An empty table gives
    no rows; other columns are not read.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, counts, _, (start, end, period) in _read(batches, False):
            firsts = offsets_of(counts)
            own = np.searchsorted(firsts, start, "right") - 1
            columns = [ids.take(pa.array(own)), *(pa.array(c, pa.int64()) for c in (start - firsts[own], end - start, period))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "period"])

    return given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, start long, length long, period long")


def collapse_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """One row per document: doc_id, n_runs, its longest run (start, length, period, exponent_milli), runs (lines of start,length,period)
    and collapsed, the words without those that some run holds after its first period, joined by one space.

    Of runs of one length the first start, then the smallest period counts; without runs its columns are null. ``planted`` first
    makes some tails periodic (``repeated_tails``). Nulls, long texts, repeated rows, empty tables and other columns as in ``find_runs``.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, codes, counts, words, (start, end, period) in _read(batches, planted):
            firsts = offsets_of(counts)
            kept = kept_words(len(codes), start, end, period)
            lists = pa.ListArray.from_arrays(pa.array(offsets_of(run_sums(kept.astype(np.int64), counts)), pa.int32()), words.take(pa.array(codes[kept])))
            bounds = np.searchsorted(start, firsts)
            best, lines = [], []
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                own = list(zip((start[a:b] - firsts[k]).tolist(), (end[a:b] - start[a:b]).tolist(), period[a:b].tolist()))
                s, n, q = min(own, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                best.append((len(own), s, n, q, None if s is None else 1000 * n // q))
                lines.append("".join("%d,%d,%d\n" % r for r in own))
            columns = [ids, *(pa.array(c, pa.int64()) for c in (zip(*best) if best else [()] * 5)), pa.array(lines, pa.string()), pc.binary_join(lists, " ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs string, collapsed string")


def run_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """``collapse_runs`` with SHA-256 digests in place of the texts."""
    out = collapse_runs(docs, doc_id, text, planted)
    return out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
