"""Exact top-k inner products by a dual search of cover trees.

Rows and queries are dealt to the nearest of a few pivots, the top level of the tree, and further into blocks
of bounded size. Where a block of queries meets a block of rows both are indexed by a cover tree: nodes with
a centre and the radius that covers all below. The trees are searched together; a pair of nodes whose largest
possible product cannot beat the worst k-th score of the query group is dropped. A first round meets the
blocks of the queries' own pivot and gives that score; in the second a query meets only pivots that may beat it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surelake import session

LEAF, FANOUT, SHRINK = 256, 16, 0.7
#: Below every score.
NONE = np.iinfo(np.int64).min


class CoverTree:
    """Nodes over the rows of a matrix: each has a centre row, a covering radius and children or rows."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.norms = np.sqrt((points * points).sum(axis=1))
        self.centre, self.radius, self.children, self.rows = [], [], [], []
        if len(points):
            self._node(np.arange(len(points)), 0)

    def _node(self, rows: np.ndarray, centre: int) -> int:
        away = self._distance(rows, centre)
        me = len(self.centre)
        self.centre.append(centre)
        self.radius.append(float(away.max()))
        self.children.append([])
        self.rows.append(rows)
        if len(rows) > LEAF and self.radius[me] > 0:
            for part, c in self._cover(rows, away, self.radius[me] * SHRINK):
                self.children[me].append(self._node(part, c))
        return me

    def _cover(self, rows: np.ndarray, away: np.ndarray, reach: float):
        """Parts around centres no nearer than ``reach`` to each other; with ``FANOUT`` centres the rest joins the nearest."""
        centres, nearest = [int(rows[np.argmin(away)])], self._distance(rows, int(rows[np.argmin(away)]))
        owner = np.zeros(len(rows), np.int64)
        while len(centres) < FANOUT and nearest.max() > reach:
            centres.append(int(rows[np.argmax(nearest)]))
            d = self._distance(rows, centres[-1])
            owner[d < nearest] = len(centres) - 1
            nearest = np.minimum(nearest, d)
        if len(centres) == 1:  # all within reach of the centre: halve by distance
            far = away > np.median(away)
            owner = far.astype(np.int64) if far.any() else (np.arange(len(rows)) % 2)
        for k in range(int(owner.max()) + 1):
            part = rows[owner == k]
            if len(part):
                yield part, centres[k] if k < len(centres) else int(part[0])

    def _distance(self, rows: np.ndarray, centre: int) -> np.ndarray:
        gap = self.points[rows] - self.points[centre]
        return np.sqrt((gap * gap).sum(axis=1))


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.score = np.full((queries, k), NONE)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.floor = floor  # scores known from elsewhere: lower ones are of no use

    def worst(self, rows: np.ndarray) -> float:
        return float(np.maximum(self.score[rows, -1], self.floor[rows]).min())

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        all_scores = np.concatenate([self.score[rows], scores], axis=1)
        all_ids = np.concatenate([self.ids[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]  # ~ turns the order and cannot overflow
        self.score[rows] = np.take_along_axis(all_scores, order, 1)
        self.ids[rows] = np.take_along_axis(all_ids, order, 1)


def search(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray) -> Best:
    """The k best rows of ``points`` for each query among those that reach its ``floor``. A row with the query's own id takes no part."""
    best = Best(len(queries), k, floor)
    asked, given = CoverTree(queries), CoverTree(points)
    stack = [(0, 0)] if len(queries) and len(points) else []
    while stack:
        q, p = stack.pop()
        if _bound(asked, q, given, [p])[0] < best.worst(asked.rows[q]):
            continue
        if not asked.children[q] and not given.children[p]:
            rows, cols = asked.rows[q], given.rows[p]
            scores = products(queries[rows], points[cols])
            scores[query_ids[rows][:, None] == ids[cols][None, :]] = NONE
            best.offer(rows, scores, ids[cols])
        elif given.children[p] and (not asked.children[q] or given.radius[p] >= asked.radius[q]):
            kids = given.children[p]
            order = np.argsort(_bound(asked, q, given, kids))  # the most promising comes off the stack first
            stack += [(q, kids[i]) for i in order]
        else:
            stack += [(c, p) for c in asked.children[q]]
    return best


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered rows, exact to 64 bits; larger ones are refused.

    Doubles hold all partial sums below 2^53. Beyond, sums of 64-bit integers wrap around and come out right where the result fits.
    """
    near = a @ b.T
    if abs(a).max(initial=0) * abs(b).max(initial=0) * max(a.shape[1], 1) < 2**53:
        return near.astype(np.int64)
    if abs(near).max(initial=0) > 9.2e18 or max(abs(a).max(initial=0), abs(b).max(initial=0)) >= 2**63:
        raise OverflowError("an inner product does not fit into 64 bits")
    return a.astype(np.int64) @ b.T.astype(np.int64)


def _bound(asked: CoverTree, q: int, given: CoverTree, nodes: list[int]) -> np.ndarray:
    """No product of a query below ``q`` and a row below a node is larger."""
    centres = [given.centre[n] for n in nodes]
    radius = np.array([given.radius[n] for n in nodes])
    c, r = asked.centre[q], asked.radius[q]
    exact = given.points[centres] @ asked.points[c] + r * given.norms[centres] + radius * asked.norms[c] + r * radius
    return exact + 1e-9 * np.abs(exact) + 1e-6


def integers(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """vec_id, v array<double> of whole numbers; rows with null, or null or non-finite components, are left out."""
    whole = F.transform(F.col(embedding), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    limit = F.lit(float("inf"))
    sound = F.forall(F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < limit))
    return vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & sound).select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))


def exact_top_k(
    vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding",
    block: int = 16384, query_block: int = 16384, most_pivots: int = 256,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query its k rows of the highest product, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``. A shorter vector counts as filled up with zeros.
    Rows with one id are rows of their own, but a query never meets its own id; a query id that occurs twice
    is asked once, with its smallest vector. An empty table gives no rows; other columns are not read. Scores are exact
    to 64 bits, a larger one is refused. The driver holds at most ``most_pivots`` vectors.
    """
    spark = vectors.sparkSession
    sound = session.materialise(integers(vectors, vec_id, embedding, scale), "vectors")
    rows, dims, n_queries = sound.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    width = max(dims or 0, 1)
    n_pivots = min(most_pivots, max(1, rows // block)) if n_queries else 1
    sample = sound.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).collect()
    pivots = spark.sparkContext.broadcast(matrix([r.v for r in sample], width))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = matrix(batch.column("v").to_pylist(), width)
            if len(pivots.value):
                gap = (m * m).sum(1)[:, None] - 2 * m @ pivots.value.T + (pivots.value * pivots.value).sum(1)[None, :]
                near = gap.argmin(axis=1)
            else:
                near = np.zeros(len(m), np.int64)
            away = np.sqrt(((m - pivots.value[near]) ** 2).sum(axis=1)) if len(pivots.value) else np.zeros(len(m))
            raw = pa.array([x.astype("<i4").tobytes() if abs(x).max(initial=0) < 2**31 else x.astype("<f8").tobytes() for x in m], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), raw, pa.array(near, pa.int32()), pa.array(away, pa.float64())], ["vec_id", "raw", "pivot", "away"])

    placed = session.materialise(sound.mapInArrow(dealt, "vec_id long, raw binary, pivot int, away double"), "vectors")
    sizes = placed.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(F.when(F.col("vec_id") % every == 0, F.col("vec_id"))).alias("queries"), F.max("away").alias("radius")
    ).collect()  # one row per pivot
    parts = {r.pivot: max(1, math.ceil(r.n / block)) for r in sizes}
    asks = {r.pivot: max(1, math.ceil(r.queries / query_block)) for r in sizes if r.queries}
    radius = spark.sparkContext.broadcast({r.pivot: r.radius for r in sizes})

    def part_of(counts: dict[int, int], salt: int):
        known = F.create_map(*[F.lit(x) for p, c in (counts or {0: 1}).items() for x in (p, c)])
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.coalesce(known[F.col("pivot")], F.lit(1))).cast("int")

    queries = placed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("raw", "pivot")).alias("x")).select("vec_id", "x.raw", "x.pivot")
    queries = queries.withColumn("ask", part_of(asks, 1)).withColumn("floor", F.lit(int(NONE)).cast("long"))
    data = placed.select("vec_id", "raw", "pivot", part_of(parts, 2).alias("part"))

    blocks = spark.createDataFrame([(p, n) for p, c in parts.items() for n in range(c)], "pivot int, part int")

    def met(queries: DataFrame) -> DataFrame:
        """Best rows where groups of queries (ask) meet the blocks of the pivots they are given. A block is sent once for each group."""
        table = queries.select("ask", "pivot").distinct()
        right = data.join(table, "pivot").select("ask", "pivot", "part", "vec_id", "raw", F.lit(None).cast("long").alias("floor"))
        left = queries.join(blocks, "pivot").select("ask", "pivot", "part", "vec_id", "raw", "floor")
        return right.unionByName(left).groupBy("ask", "pivot", "part").applyInArrow(found, "query_id long, vec_id long, score long")

    def found(rows: pa.Table) -> pa.Table:
        ids, floor = rows.column("vec_id").to_numpy(), rows.column("floor")
        m = np.stack([unpacked(x, width) for x in rows.column("raw").to_pylist()])
        q, floor = floor.is_valid().to_numpy(), floor.drop_null().to_numpy()
        best = search(m[q], ids[q], m[~q], ids[~q], k, floor)
        n, at = np.nonzero((best.score > NONE) & (best.score >= floor[:, None]))
        return pa.table({"query_id": pa.array(ids[q][n], pa.int64()), "vec_id": pa.array(best.ids[n, at], pa.int64()), "score": pa.array(best.score[n, at])})

    def best_of(found_rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found_rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = session.materialise(best_of(met(queries)), "top-k")
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth"))
    queries = session.materialise(queries.drop("floor").join(kth, "vec_id", "left").select("vec_id", "raw", "pivot", "ask", F.coalesce("kth", F.lit(int(NONE)).cast("long")).alias("floor")), "queries")

    groups = max(1, math.ceil(n_queries / query_block))

    def reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with each other pivot whose rows may beat their k-th score."""
        norms = np.sqrt((pivots.value**2).sum(axis=1))
        reach = np.array([radius.value.get(p, -np.inf) for p in range(len(norms))])
        for batch in batches:
            m = np.stack([unpacked(x, width) for x in batch.column("raw").to_pylist()]) if batch.num_rows else np.zeros((0, width))
            top = m @ pivots.value.T + np.sqrt((m * m).sum(1))[:, None] * np.maximum(reach, 0)[None, :]
            top += 1e-3 + 1e-9 * np.abs(top)
            open_ = (top >= batch.column("floor").to_numpy()[:, None]) & (reach >= 0)[None, :]
            n, p = np.nonzero(open_ & (batch.column("pivot").to_numpy()[:, None] != np.arange(len(norms))[None, :]))
            rows = batch.take(pa.array(n))
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("raw"), rows.column("floor"), pa.array(p, pa.int32())], ["vec_id", "raw", "floor", "pivot"])

    open_pairs = queries.select("vec_id", "raw", "floor", "pivot").mapInArrow(reachable, "vec_id long, raw binary, floor long, pivot int")
    rest = met(open_pairs.withColumn("ask", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")))
    return best_of(first.drop("rank").unionByName(rest)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def matrix(vectors: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for n, v in enumerate(vectors):
        out[n, : len(v)] = v
    return out


def unpacked(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4" if len(raw) == 4 * width else "<f8").astype(np.float64)


def sql(k: int = 10, every: int = 100, scale: int = 1024) -> str:
    return f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
    FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % {every} = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {k}
"""
