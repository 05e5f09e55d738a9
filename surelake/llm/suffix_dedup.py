"""Repeated passages, byte by byte, by suffix arrays over the neighbourhoods of shared stretches.

Every string of ``length`` bytes holds stretches of half that length; the one of smallest hash is its
anchor, so equal strings have equal anchors at the same offset. Anchors meet by hash. All strings with an
anchor lie in its context, the bytes around it: equal contexts are one context with a weight, and the
distinct contexts of an anchor go through a suffix array, whose neighbours share their first bytes
wherever any two do. A start is repeated if its neighbour shares ``length`` bytes, compared in full.

The suffix array is built in linear time by grouping: suffixes are sorted by their longest Lyndon prefix,
taking the groups in descending order and hanging each suffix on the previous smaller one, whose group is
split by how many suffixes it got; then one pass over the groups puts out the order, without renaming
or recursion.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surelake import session
from surelake.llm.common import shuffle_partitions, small_batches, text_of

KEY = ["k1", "k2"]
#: Starts of a very long text that are looked at together.
PIECE = 1 << 20
#: Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


# Suffix array

def lyndon_groups(symbols: list[int]) -> tuple[list[list[int]], list[int]]:
    """(groups of the suffixes 1..n by their longest Lyndon prefix, descending; previous smaller suffix of each, 0 for none)."""
    n = len(symbols)
    places: dict[int, list[int]] = {}
    for i, c in enumerate(symbols, 1):
        places.setdefault(c, []).append(i)
    members, group = [], [0] * (n + 1)
    for c in sorted(places):
        for i in places[c]:
            group[i] = len(members)
        members.append(places[c])
    size = [len(m) for m in members]
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    before = [-1] * (n + 1)  # of a suffix whose group is done
    done = []
    at = len(members) - 1
    while at >= 0:
        own = [i for i in members[at] if group[i] == at]  # others have moved up since
        if len(own) == 1:
            i = own[0]
            j = i - 1
            while (k := before[j]) >= 0:
                j = k
            before[i] = j
            done.append(own)
            counts = {j: 1} if j else {}
        elif own:
            own.sort()
            counts = {}
            for i in own:
                j = i - 1
                while (k := before[j]) >= 0:
                    j = k
                before[i] = j
                counts[j] = counts.get(j, 0) + 1
            done.append(own)
            counts.pop(0, None)
        else:
            counts = {}
        # a suffix whose prefix grew moves to a new group right above its old one, those that grew more further up
        split: dict[tuple[int, int], list[int]] = {}
        for j, c in counts.items():
            h = group[j]
            if size[h] > 1:
                split.setdefault((-c, h), []).append(j)
        for (_, h), moved in sorted(split.items()) if len(split) > 1 else split.items():
            if len(moved) < size[h]:
                size[h] -= len(moved)
                g = len(members)
                for j in moved:
                    group[j] = g
                members.append(moved)
                size.append(len(moved))
                above.append(above[h])
                below.append(h)
                below[above[h]] = g
                above[h] = g
        at = below[at]
    return done, before


def suffix_array(symbols: list[int]) -> list[int]:
    """Places of all suffixes in ascending order; a suffix is smaller than those it begins."""
    groups, before = lyndon_groups(symbols)
    n = len(symbols)
    group, head, start = [0] * (n + 1), [], 0
    for g, own in enumerate(reversed(groups)):
        head.append(start)
        start += len(own)
        for i in own:
            group[i] = g
    out = [0] * n
    placed = bytearray(n + 2)
    placed[0] = 1
    for i in range(-1, n):
        j = n if i < 0 else out[i] - 1
        while not placed[j]:  # suffixes whose Lyndon prefix ends here come in the order of what follows it
            g = group[j]
            out[head[g]] = j
            head[g] += 1
            placed[j] = 1
            j = before[j]
    return [i - 1 for i in out]


# Anchors

@cache
def powers(base: int, n: int) -> np.ndarray:
    """1, b, b^2, ... modulo 2^64."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        k = min(done, n - done)
        out[done : done + k] = out[:k] * np.uint64(pow(base, done, 1 << 64))
        done += k
    return out


class Rolling:
    """Hashes of any stretches of bytes, equal for equal bytes."""

    def __init__(self, raw: np.ndarray, base: int):
        room = 1 << max(16, int(len(raw)).bit_length())
        self.back = powers(pow(base, -1, 1 << 64), room)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(base, room)[: len(raw)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[begin]) * self.back[begin]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(29)


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors_of(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, hash of the context, bytes of the context after the anchor) of all anchors of a text."""
    n, core = len(raw), length // 2
    flank = length - core
    found = []
    for s in range(0, n - length + 1, PIECE):
        e = min(s + PIECE, n - length + 1)
        base = max(0, s - flank)
        part = raw[base : min(n, e - 1 + length + flank)]
        first, second = (Rolling(part, b) for b in BASES)
        at = np.arange(s, e + flank) - base
        h = first.of(at, at + core)
        least = lowest(h, flank + 1)  # of the stretches of each string
        edge = np.zeros(flank, np.uint64)
        most = ~lowest(~np.concatenate([edge, least, edge]), flank + 1)
        picked = most == h
        at, h = at[picked] + base, h[picked]
        left, right = np.minimum(at, flank), np.minimum(n - core - at, flank)
        context = second.of(at - left - base, at + core + right - base) ^ (left * 512 + right).astype(np.uint64)
        found.append((at, h.view(np.int64), context.view(np.int64), right))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    at, h, context, right = (np.concatenate(c) for c in zip(*found))
    at, once = np.unique(at, return_index=True)  # neighbouring pieces may share some
    return at, h[once], context[once], right[once]


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered stretches of intervals."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    fresh = np.concatenate([[True], low[1:] > high[:-1]])
    return low[fresh], high[np.concatenate([fresh[1:], [True]])]


#: kind 0: bytes low to high of text (k1, k2) are repeated. kind 1: an anchor at ``low``, its context ends at ``high``;
#: ``twice``: its context occurs again and the spans of this batch are told already. kind 2: like 1, of an anchor with very many rows.
ROW = "kind int, gram long, context long, k1 long, k2 long, low long, high long, twice boolean, route long"
NAMES = [c.split()[0] for c in ROW.split(", ")]
TYPES = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def batch_of(schema: str, columns) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, TYPES[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def anchors(texts: DataFrame, length: int, hot=None) -> DataFrame:
    """Anchors of all texts (k1, k2, text). What a batch holds several times goes on once, with the spans found by that."""
    core = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = hot.value if hot is not None else np.zeros(0, np.int64)
        for batch in small_batches(batches, "text", 4 << 20):
            keys = [batch.column(c).to_numpy() for c in KEY]
            raws = [np.frombuffer(t.as_buffer(), np.uint8) for t in batch.column("text")]
            found = [anchors_of(r, length) for r in raws]
            own = np.repeat(np.arange(len(raws)), [len(f[0]) for f in found])
            if not len(own):
                continue
            at, gram, context, right = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((context, gram))
            own, at, gram, context, right = (c[order] for c in (own, at, gram, context, right))
            fresh = np.concatenate([[True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])])
            again = ~fresh | np.concatenate([~fresh[1:], [False]])
            spans = [(k, low, high) for k, low, high in covered(own[again], at[again] - np.minimum(at[again], length - core), at[again] + core + right[again])]
            k, low, high = (np.concatenate(c) for c in zip(*spans)) if spans else (np.zeros(0, np.int64),) * 3
            none = np.zeros(len(k), np.int64)
            yield batch_of(ROW, [none, none, none, keys[0][k], keys[1][k], low, high, none.astype(bool), keys[0][k]])
            own, at, gram, context, right, again = (c[fresh] for c in (own, at, gram, context, right, again))
            many = often[np.minimum(np.searchsorted(often, gram), len(often) - 1)] == gram if len(often) else np.zeros(len(gram), bool)
            route = np.where(many, keys[0][own] ^ at * 0x5851F42D4C957F2D, gram)
            yield batch_of(ROW, [1 + many, gram, context, keys[0][own], keys[1][own], at, at + core + right, again, route])

    return texts.select(*KEY, "text").mapInArrow(run, ROW)


def covered(own: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Merged intervals of each text: (text, low, high)."""
    order = np.argsort(own, kind="stable")
    own, low, high = own[order], low[order], high[order]
    cuts = np.flatnonzero(np.diff(own)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(own)]):
        if b > a:
            x, y = merged(low[a:b], high[a:b])
            yield np.full(len(x), own[a]), x, y


def meet(rows: DataFrame, length: int) -> DataFrame:
    """Rows sorted by anchor and context: spans of contexts that occur again (kind 0), and one row per context of anchors with several (kind 1)."""
    core = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            kind, gram = held["kind"].to_numpy(), held["gram"].to_numpy()
            begin = int(np.searchsorted(kind, 1))
            whole = begin + int(np.searchsorted(gram[begin:], gram[-1])) if kind[-1] == 1 else len(kind)  # the last anchor may go on
            if whole:
                yield from settle(held.slice(0, whole))
                held = held.slice(whole) if whole < len(kind) else None
        if held is not None:
            yield from settle(held)

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        kind = rows["kind"].to_numpy()
        for other in rows.filter(pa.array(kind != 1)).to_batches():
            yield pa.RecordBatch.from_arrays(other.columns, NAMES)
        rows = rows.filter(pa.array(kind == 1))
        if not rows.num_rows:
            return
        gram, context, k1, k2, low, high, twice = (rows[c].to_numpy() for c in NAMES[1:8])
        new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
        new = new_gram | np.concatenate([[True], context[1:] != context[:-1]])
        number, first = np.cumsum(new) - 1, np.flatnonzero(new)
        size = np.diff(np.append(first, len(gram)))
        again = (size > 1) | np.logical_or.reduceat(twice, first)
        untold = again[number] & ~twice
        none = np.zeros(int(untold.sum()), np.int64)
        start = low - np.minimum(low, length - core)
        yield batch_of(ROW, [none, none, none, k1[untold], k2[untold], start[untold], high[untold], none.astype(bool), none])
        contexts = np.add.reduceat(new, np.flatnonzero(new_gram))
        several = (contexts > 1)[np.cumsum(new_gram) - 1][first]
        rep = first[several]
        one = np.ones(len(rep), np.int64)
        yield batch_of(ROW, [one, gram[rep], context[rep], k1[rep], k2[rep], low[rep], high[rep], again[several], one])

    return rows.mapInArrow(run, ROW)


# Contexts

CONTEXT = "gram long, k1 long, k2 long, at long, twice boolean, left binary, right binary"
STRING = "digest binary, k1 long, k2 long, low long, twice boolean"
SPAN = "k1 long, k2 long, low long, high long"


def contexts(texts: DataFrame, wanted: DataFrame, length: int, strings: bool) -> DataFrame:
    """The bytes around each wanted anchor (gram, k1, k2, low, twice); with ``strings`` the digests of all strings around it."""
    core = length // 2
    flank = length - core

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            out, size = [], 0
            for k1, k2, text, own in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("text"), batch.column("wanted").to_pylist()):
                raw = text.as_buffer().to_pybytes()
                for w in own:
                    at = w["low"]
                    if strings:
                        for low in range(max(0, at - flank), min(at, len(raw) - length) + 1):
                            out.append((hashlib.blake2b(raw[low : low + length], digest_size=16).digest(), k1, k2, low, w["twice"]))
                    else:
                        out.append((w["gram"], k1, k2, at, w["twice"], raw[max(0, at - flank) : at], raw[at + core : at + core + flank]))
                    if len(out) >= 20_000:
                        yield batch_of(STRING if strings else CONTEXT, zip(*out))
                        out = []
            if out:
                yield batch_of(STRING if strings else CONTEXT, zip(*out))

    grouped = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("gram", "low", "twice")).alias("wanted"))  # at most the anchors of one text
    return texts.join(grouped, KEY).select(*KEY, "text", "wanted").mapInArrow(run, STRING if strings else CONTEXT)


def shared_ends(groups: list[int], ends: list[bytes], flank: int) -> np.ndarray:
    """How many first bytes each end shares with the most alike other end of its group, by sorting."""
    order = sorted(range(len(ends)), key=lambda i: (groups[i], ends[i]))
    grid = np.frombuffer(b"".join(ends[i].ljust(flank, b"\0") for i in order), np.uint8).reshape(len(order), flank)
    size = np.array([len(ends[i]) for i in order])
    group = np.array([groups[i] for i in order])
    equal = grid[1:] == grid[:-1]
    shared = np.where(equal.all(axis=1), flank, equal.argmin(axis=1)) if len(equal) else np.zeros(0, np.int64)
    shared = np.where(group[1:] == group[:-1], np.minimum(shared, np.minimum(size[1:], size[:-1])), 0)
    out = np.zeros(len(order), np.int64)
    out[order] = np.maximum(np.append(shared, 0), np.insert(shared, 0, 0))
    return out


def repeated_runs(groups: list[int], lefts: list[bytes], rights: list[bytes], twice: list[bool], length: int) -> list[list[tuple[int, int]]]:
    """Of each context (bytes before and after the anchor of its group) the runs of repeated starts, as bytes before the anchor: (most, least).

    Bytes that no other context of the group shares are cut off first; contexts equal after that are one with
    a weight, and some that lie in another are part of it. The rest are sorted; the anchor counts as one symbol of its group.
    Runs may overlap.
    """
    flank = length - length // 2
    backward = [x[::-1] for x in lefts]
    left = np.where(twice, [len(x) for x in lefts], shared_ends(groups, backward, flank))
    right = np.where(twice, [len(x) for x in rights], shared_ends(groups, rights, flank))
    alike: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(left + right >= flank).tolist():
        alike.setdefault((groups[i], backward[i][: left[i]], rights[i][: right[i]]), []).append(i)
    out: list[list[tuple[int, int]]] = [[] for _ in groups]
    by_group: dict[int, list[tuple]] = {}
    for (g, back, after), own in alike.items():
        by_group.setdefault(g, []).append((back, after, own, len(own) > 1 or twice[own[0]]))
    left_over = []  # (group, bytes backward, bytes forward, contexts, whether all of it is repeated, runs known to be)
    for g, own in by_group.items():
        outer = take_inner(own, flank, out)
        if len(outer) > 1:
            left_over += [(g, *x) for x in outer]
        else:
            settle_alone(outer, flank, out)
    if not left_over:
        return out
    names = {g: 257 + n for n, g in enumerate(dict.fromkeys(x[0] for x in left_over))}
    symbols, center, tail, known = [], [], [], []
    for g, back, after, own, weighty, inner in left_over:
        symbols += [c + 1 for c in reversed(back)]
        center.append(len(symbols))
        symbols.append(names[g])
        symbols += [c + 1 for c in after]
        symbols.append(0)
        tail.append(len(after))
        known += [(center[-1] - most, center[-1] - least) for most, least in ([(len(back), max(0, flank - len(after)))] if weighty else inner)]
    center, tail = np.array(center), np.array(tail)
    lead = np.diff(np.insert(center + tail + 2, 0, 0)) - tail - 2  # bytes before each center
    n = lead - np.maximum(flank - tail, 0) + 1  # starts of whole strings: no more than ``lead``, no less than ``flank - tail`` before the center
    context = np.repeat(np.arange(len(n)), n)
    starts = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(center - lead, n)
    valid = np.zeros(len(symbols), bool)
    valid[starts] = True
    repeated = np.zeros(len(symbols), bool)
    for first, last in known:
        repeated[first : last + 1] = True
    order = np.array(suffix_array(symbols))
    both = valid[order[1:]] & valid[order[:-1]]
    x, y = order[:-1][both], order[1:][both]
    flat = np.array(symbols, np.int32)
    for a in range(0, len(x), 1 << 14):
        one, two = x[a : a + (1 << 14)], y[a : a + (1 << 14)]
        same = np.ones(len(one), bool)
        for step in (1, 8, flank + 1):  # most unequal pairs differ soon
            at = np.flatnonzero(same)
            window = np.arange(min(step, flank + 1))
            same[at] = (flat[one[at][:, None] + window] == flat[two[at][:, None] + window]).all(axis=1)
        repeated[one[same]] = True
        repeated[two[same]] = True
    hit = repeated[starts]
    before = center[context] - starts
    edge = np.concatenate([[True], ~hit[:-1] | (context[1:] != context[:-1])]) & hit
    close = np.concatenate([~hit[1:] | (context[1:] != context[:-1]), [True]]) & hit
    for c, most, least in zip(context[edge].tolist(), before[edge].tolist(), before[close].tolist()):
        for i in left_over[c][3]:
            out[i].append((most, least))
    return out


def take_inner(contexts: list[tuple], flank: int, out: list[list[tuple[int, int]]], rounds: int = 4) -> list[tuple]:
    """The contexts of one anchor without those that lie in one of the longest: these are repeated whole, and known runs of the longer one."""
    rest, outer = sorted(contexts, key=lambda c: -len(c[0]) - len(c[1])), []
    for _ in range(rounds):
        if not rest:
            break
        back, after, own, weighty = rest[0]
        inner, others = [], []
        for c in rest[1:]:
            if back.startswith(c[0]) and after.startswith(c[1]):
                run = len(c[0]), max(0, flank - len(c[1]))
                inner.append(run)
                for i in c[2]:
                    out[i].append(run)
            else:
                others.append(c)
        outer.append((back, after, own, weighty, inner))
        rest = others
    return outer + [(*c, []) for c in rest]


def settle_alone(outer: list[tuple], flank: int, out: list[list[tuple[int, int]]]) -> None:
    """Runs of the only context left of an anchor."""
    for back, after, own, weighty, inner in outer:
        for i in own:
            out[i] += [(len(back), max(0, flank - len(after)))] if weighty else inner


def suffix_spans(rows: DataFrame, length: int, most_symbols: int = 40_000) -> DataFrame:
    """Repeated spans of contexts that come sorted by anchor; anchors are taken together up to ``most_symbols`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last and size > most_symbols:
                    yield spans(held)
                    held, size = [], 0
                last = row[0]
                held.append(row)
                size += len(row[5]) + len(row[6])
        if held:
            yield spans(held)

    def spans(held: list[tuple]) -> pa.RecordBatch:
        gram, k1, k2, at, twice, left, right = map(list, zip(*held))
        out = []
        for i, found in enumerate(repeated_runs(gram, left, right, twice, length)):
            if not twice[i]:  # spans of the others are known
                out += [(k1[i], k2[i], at[i] - most, at[i] - least + length) for most, least in found]
        return batch_of(SPAN, zip(*out) if out else [()] * 4)

    return rows.mapInArrow(run, SPAN)


# The operator

def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def hot_anchors(texts: DataFrame, length: int, rows: int, sample_rows: int, hot_share: float, most_hot: int) -> np.ndarray:
    """Anchors that at least a share of a sample of texts hold, most frequent first, at most ``most_hot``: they are only dealt differently."""
    share = min(1.0, sample_rows / max(rows, 1))
    least = max(8, int(hot_share * share * rows))
    sample = anchors(texts.sample(False, share, 3) if share < 1 else texts, length).where("kind = 1")
    found = sample.groupBy("gram").count().where(F.col("count") >= least).orderBy(F.desc("count"), "gram").limit(most_hot)
    return np.sort(np.array([r.gram for r in found.collect()], np.int64))


def repeated_spans(texts: DataFrame, length: int, distinct: DataFrame, most_contexts: int, sample_rows: int, hot_share: float, most_hot: int) -> DataFrame:
    """(k1, k2, low, high): bytes of the texts that lie in a string of ``length`` bytes that starts elsewhere as well. Spans may overlap."""
    spark, parts = texts.sparkSession, shuffle_partitions(texts.sparkSession)
    hot = spark.sparkContext.broadcast(hot_anchors(texts, length, texts.count(), sample_rows, hot_share, most_hot))
    dealt = anchors(texts, length, hot).repartition(parts, "route").sortWithinPartitions("kind", "gram", "context", *KEY, "low")
    found = session.materialise(meet(dealt, length), "repeats")

    # anchors with very many rows were dealt at random and are counted instead
    often = found.where("kind = 2")
    counted = often.groupBy("gram", "context").agg((F.count_if(~F.col("twice")) + 2 * F.count_if("twice")).alias("n"), F.min(F.struct(*KEY, "low")).alias("rep"))
    again = counted.where("n > 1").select("gram", "context")
    known = found.where("kind = 0").select(*KEY, "low", "high")
    more = often.where("not twice").join(again, ["gram", "context"], "left_semi").select(*KEY, (F.col("low") - F.least("low", F.lit(length - length // 2))).alias("low"), "high")

    wanted = found.where("kind = 1").select("gram", *KEY, "low", "twice").unionByName(counted.select("gram", *[F.col(f"rep.{c}").alias(c) for c in (*KEY, "low")], (F.col("n") > 1).alias("twice")))
    large = wanted.groupBy("gram").count().where(F.col("count") > most_contexts).select("gram")
    around = contexts(distinct, wanted.join(large, "gram", "left_anti"), length, False)
    by_suffix = suffix_spans(around.repartition(parts, "gram").sortWithinPartitions("gram"), length)

    # the strings of anchors with more contexts than a task should sort at once are counted by their digests
    strings = contexts(distinct, wanted.join(large, "gram", "left_semi"), length, True)
    place = F.struct(*KEY, "low")  # one string lies in the contexts of several anchors
    digests = strings.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.bool_or("twice").alias("twice")).where("twice or first <> last").select("digest")
    by_count = strings.where("not twice").join(digests, "digest", "left_semi").select(*KEY, "low", (F.col("low") + length).alias("high"))
    return known.unionByName(more).unionByName(by_suffix).unionByName(by_count)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 200, digest: bool = False, most_contexts: int = 8192, sample_rows: int = 20_000, hot_share: float = 0.005, most_hot: int = 10_000
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, spans (of low, high) and kept, the bytes that stay; with ``digest`` kept_sha256 instead.

    A byte goes if some string of ``length`` UTF-8 bytes that covers it starts anywhere else too, in the same or another document;
    matches never cross documents, and strings are judged on the input. A null text counts as empty; texts shorter than
    ``length`` stay whole, copies of a longer text all go. Repeated rows and null ids are documents of their own. Very long texts are
    read whole, ``PIECE`` starts at a time. An empty table gives no rows; other columns are not read.
    ``hot_share``: anchors found in that share of ``sample_rows`` texts, at most ``most_hot``, are dealt over all tasks. An anchor with
    more than ``most_contexts`` different contexts is not sorted by one task; its strings are counted by digest. Neither changes the result.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    texts = base.select(*text_key(F.col("text")), "text")
    distinct = texts.groupBy(*KEY).agg(F.first("text").alias("text"))
    spans = repeated_spans(texts, length, distinct, most_contexts, sample_rows, hot_share, most_hot)
    by_text = spans.groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("spans"))  # bounded by the text
    last = "kept_sha256 string" if digest else "kept binary"
    cut = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            out = []
            for raw, own in zip(batch.column("text"), batch.column("spans")):
                raw = raw.as_buffer().to_pybytes()
                low, high = (own.values.field(c).to_numpy() for c in range(2)) if own.is_valid else (np.zeros(0, np.int64),) * 2
                low, high = merged(low, high)
                low, high = low.tolist(), high.tolist()
                kept = b"".join(raw[a:b] for a, b in zip([0, *high], [*low, len(raw)]))
                out.append((len(raw), len(raw) - len(kept), len(low), [{"low": a, "high": b} for a, b in zip(low, high)], hashlib.sha256(kept).hexdigest() if digest else kept))
            types = [pa.int64(), pa.int64(), pa.int64(), cut, pa.string() if digest else pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, types)]
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), *columns], ["k1", "k2", "n_bytes", "n_removed", "n_spans", "spans", last.split()[0]])

    judged = distinct.join(by_text, KEY, "left").select(*KEY, "text", "spans").mapInArrow(run, f"k1 long, k2 long, n_bytes long, n_removed long, n_spans long, spans array<struct<low: long, high: long>>, {last}")
    return base.select("doc_id", *text_key(F.col("text"))).join(judged, KEY).drop(*KEY)
