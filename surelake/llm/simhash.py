"""Near duplicates by SimHash fingerprints that differ in few bits.

Fingerprints that differ in at most d bits agree in at least two of d + 2 blocks, so each is routed
once per pair of blocks to the others with the same bits there. Inside a route a hierarchical index
is built: fingerprints sorted by Gray rank, neighbours grouped, the bits a group shares factored into
its node, level by level. The index is searched against itself from the top; a pair of nodes whose
shared bits already differ in more than d places is dropped with all rows below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surelake import session
from surelake.llm.common import small_batches

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
FAN = 8
STEP = 1 << 20


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Majority bits of the hashes of all word shingles; the whole text if shorter; 0 without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
        ends = starts[shingle:] - 1
        hashes = [xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[: len(ends)].tolist(), ends.tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], ">u8")
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, digest: bool = False) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) and, if asked, the text's digest (null for a null text)."""
    others = ["doc_id", "sha"] if digest else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            fp = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(fp, pa.int64())], [*others, "fp"])

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *[sha_of(text).alias(c) for c in others[1:]])
    kinds = [f"{c} {given.schema[c].dataType.simpleString()}" for c in others]
    return given.mapInArrow(run, ", ".join([*kinds, "fp long"]))


def sha_of(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Place of a 64-bit code in the Gray sequence."""
    rank = code.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    return rank


def linked(cell: np.ndarray, code: np.ndarray, distance: int) -> np.ndarray:
    """For each row the first row of its group, rows of a cell being grouped through pairs within ``distance`` bits.

    Rows must come sorted by (cell, Gray rank). All cells are searched together.
    """
    rows = np.arange(len(code))
    begins = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    size = np.diff(np.append(begins, len(code)))
    # levels[k]: (shared mask, shared bits, first child, children) of nodes of FAN nodes of level k - 1
    levels = [(np.full(len(code), ~np.uint64(0)), code, rows, np.ones(len(code), np.int64))]
    both, any_ = code, code
    first, count = begins, size
    while len(begins) and count.max() > 1:
        per = (count + FAN - 1) // FAN
        ends = np.cumsum(per)
        within = np.arange(ends[-1]) - np.repeat(ends - per, per)
        child = np.repeat(first, per) + within * FAN
        children = np.minimum(FAN, np.repeat(first + count, per) - child)
        both, any_ = np.bitwise_and.reduceat(both, child), np.bitwise_or.reduceat(any_, child)
        mask = ~(both ^ any_)
        levels.append((mask, both & mask, child, children))
        first, count = ends - per, per
    label = rows.copy()
    stack = [(len(levels) - 1, first, first)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > STEP // (FAN * FAN):
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        if level == 0:
            _unite(label, a, b)
            continue
        _, _, child, children = levels[level]
        n, m = children[a], children[b]
        pair = np.repeat(np.arange(len(a)), n * m)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
        left, right = child[a][pair] + place // m[pair], child[b][pair] + place % m[pair]
        mask, bits = levels[level - 1][:2]
        apart = np.bitwise_count((bits[left] ^ bits[right]) & mask[left] & mask[right])
        keep = (apart <= distance) & ((left < right) if level == 1 else (left <= right))
        if keep.any():
            stack.append((level - 1, left[keep], right[keep]))
    return label


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of a and b; a group is named by its first row."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def block_masks(blocks: int) -> list[int]:
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    return [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges[:-1], edges[1:])]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(codes: DataFrame, distance: int = 4, chunk: int = 4096) -> DataFrame:
    """Different fingerprints ``fp`` -> pairs (a, b) that span all groups within every route.

    A route with more than ``chunk`` fingerprints is dealt into parts, and every two parts meet in a cell of
    their own, so no task holds more than two parts and no pair is left out.
    """
    masks = block_masks(distance + 2)
    routes = [F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(signed(x | y))).alias("bits")) for n, (x, y) in enumerate(combinations(masks, 2))]
    routed = codes.select("fp", F.explode(F.array(*routes)).alias("route")).select("fp", "route.n", "route.bits")
    hot = routed.groupBy("n", "bits").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > chunk)
    parts = F.ceil(2 * F.col("rows") / chunk).cast("int")
    dealt = routed.join(hot, ["n", "bits"], "left").withColumns({"parts": F.coalesce(parts, F.lit(1)), "part": F.lit(0)})
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    other = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: k != F.col("part")))
    met = dealt.select("fp", "n", "bits", "part", F.explode(other).alias("other"))
    cell = F.xxhash64("n", "bits", F.least("part", "other"), F.greatest("part", "other"))  # cells that collide only compare more pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, codes_ = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def found(cells, codes_):
            order = np.lexsort((gray_rank(codes_), cells))
            cells, codes_ = cells[order], codes_[order]
            label = linked(cells, codes_, distance)
            moved = np.flatnonzero(label != np.arange(len(label)))
            a, b = codes_[moved].view(np.int64), codes_[label[moved]].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            cells = np.concatenate([cells, batch.column("cell").to_numpy()])
            codes_ = np.concatenate([codes_, batch.column("fp").to_numpy().view(np.uint64)])
            last = int(np.searchsorted(cells, cells[-1])) if len(cells) else 0  # the last cell may go on
            if last > 50_000:
                yield found(cells[:last], codes_[:last])
                cells, codes_ = cells[last:], codes_[last:]
        if len(cells):
            yield found(cells, codes_)

    sorted_ = met.select(cell.alias("cell"), "fp").repartition("cell").sortWithinPartitions("cell")
    return sorted_.mapInArrow(run, "a long, b long")


def components(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) -> (node, root): every node of a pair and the smallest node it reaches.

    Large-star and small-star steps on tables in the shared folder; each halves the distance to the root.
    """
    now = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = session.materialise(now, "links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        now = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = now.groupBy("u").agg(F.min("v").alias("m"))
        joined = now.join(low, "u")
        now = joined.select("u", F.col("m").alias("v")).unionByName(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        now = session.materialise(now, "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest id reachable over links of at most ``distance`` bits.

    Texts without words (null, empty, white space) have fingerprint zero and are linked like any other. A null
    id is never a component id unless its component has no other. Rows with one id are separate rows. An empty
    table gives no rows; other columns are not read.
    """
    prints = session.materialise(fingerprints(docs, doc_id, text, shingle), "simhash")
    named = named_codes(prints, distance)
    return prints.join(named, "fp", "left").select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def named_codes(prints: DataFrame, distance: int) -> DataFrame:
    """Different fingerprints ``fp`` of rows (doc_id, fp) with the ``root`` of their component, one number for each, and its component_id."""
    codes = session.materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-codes")
    roots = components(links(codes.select("fp"), distance))
    rooted = codes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("codes")).where("codes > 1")
    return rooted.join(groups, "root", "left").select("fp", "root", F.coalesce("component_id", "first_id").alias("component_id"))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """One document of every component, with all columns: the smallest id, null last, then by fingerprint and digest of the text; of
    rows equal in id and text one, by the other columns. Rows with one id or none are separate rows. Texts without words are linked like any
    other, long ones are read whole. Columns may have any names; an empty table gives no rows."""
    prints = session.materialise(fingerprints(docs, doc_id, text, shingle, digest=True), "simhash")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "sha")
    best = prints.join(named_codes(prints, distance).select("fp", "root"), "fp").groupBy("root").agg(F.min(rank).alias("best"))
    stays = best.select(F.col("best.doc_id").alias("id"), F.col("best.sha").alias("sha"))  # the digest settles the fingerprint
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{doc_id}`").alias("id"), sha_of(text).alias("sha"))
    joined = own.join(stays, [own[k].eqNullSafe(stays[k]) for k in ("id", "sha")], "left_semi")
    order = F.struct(*[F.col(f"row.`{c}`").cast("string") for c in docs.columns if c != text] or [F.lit(0)])
    return joined.groupBy("id", "sha").agg(F.min_by("row", order).alias("row")).select("row.*")
