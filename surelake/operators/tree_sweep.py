"""Decision trees of many depths and bin counts from shared statistics.

Every feature is cut into cells once. A level of all trees is grown by one pass: counts per (tree, node, feature, cell), from which cumulative
sums give the best cut of every node. Coarser bins are the same cells with fewer cuts allowed, a smaller depth is the same tree cut off, so
the passes are those of one tree, not of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import session


def fine_cuts(df: DataFrame, columns: list[str], bins: int, error: float = 1e-4) -> list[list[float]]:
    """Up to ``bins`` - 1 cuts of each column, at values that part its rows evenly; a row is left of a cut if it is not above it."""
    found = df.approxQuantile(columns, [n / bins for n in range(1, bins)], error)
    tops = df.agg(*[F.max(c) for c in columns]).first()
    return [sorted({x for x in cuts if top is not None and x < top}) for cuts, top in zip(found, tops)]


def allowed(cuts: int, bins: int) -> list[int]:
    """Numbers of the cuts that a tree with so many bins may use, evenly among all."""
    return list(range(cuts)) if cuts < bins else sorted({n * (cuts + 1) // bins - 1 for n in range(1, bins)} - {-1})


def _cells(df: DataFrame, columns: list[str], cuts: list[list[float]], label: str, bins: list[int]) -> DataFrame:
    cell = [sum((F.when(F.col(c) > F.lit(float(x)), 1).otherwise(0) for x in each), F.lit(0)) for c, each in zip(columns, cuts)]
    rows = df.where(F.col(label).isNotNull()).select(F.array(*cell).alias("cells"), F.col(label).cast("int").alias("label"))
    return rows.withColumn("bins", F.explode(F.array(*[F.lit(b) for b in bins]))).withColumn("node", F.lit(1).cast("long"))


def _impurity(counts: list[Column], kind: str) -> Column:
    n = sum(counts, F.lit(0))
    share = [c / n for c in counts]
    if kind == "gini":
        return F.lit(1.0) - sum((p * p for p in share), F.lit(0.0))
    return -sum((F.when(c > 0, p * F.log2(p)).otherwise(0.0) for c, p in zip(counts, share)), F.lit(0.0))


def _down(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows at their node of the next level; at a leaf they stay, with ``open`` false."""
    moved = rows.drop("open").join(F.broadcast(splits), ["bins", "node"], "left")  # a row per node
    side = F.when(F.get("cells", F.col("feature")) > F.col("cut"), 1).otherwise(0)
    return moved.select("cells", "label", "bins", F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.col("node") * 2 + side).alias("node"), F.col("feature").isNotNull().alias("open"))


def grow(rows: DataFrame, cuts: list[list[float]], classes: int, bins: list[int], depth: int, impurity: str = "entropy", most_nodes: int = 100_000) -> list[tuple]:
    """(bins, node, prediction, feature, cut) of all nodes of all trees; the children of node n are 2 n and 2 n + 1, a leaf has no feature.

    Ties go to the first feature and cut, among classes to the smallest. The driver holds a row per node; more than ``most_nodes`` are refused.
    """
    spark = rows.sparkSession
    steps = spark.createDataFrame([(b, f, allowed(len(c), b)) for b in bins for f, c in enumerate(cuts)], "bins int, feature int, allowed array<int>")
    names = [f"c{k}" for k in range(classes)]
    found: list[tuple] = []
    now = rows.withColumn("open", F.lit(True))
    for level in range(depth + 1):
        each = now.where("open").select("bins", "node", "label", F.posexplode("cells").alias("feature", "cell"))
        cells = each.groupBy("bins", "node", "feature", "cell").agg(*[F.count_if(F.col("label") == k).alias(c) for k, c in enumerate(names)])
        order = Window.partitionBy("bins", "node", "feature").orderBy("cell")
        whole = Window.partitionBy("bins", "node", "feature")
        left = [F.sum(c).over(order) for c in names]
        total = [F.sum(c).over(whole) for c in names]
        cut = F.array_min(F.filter("allowed", lambda j: j >= F.col("cell")))
        parts = cells.join(F.broadcast(steps), ["bins", "feature"]).select(  # a row per tree and feature
            "bins", "node", "feature", cut.alias("cut"), F.lead("cell").over(order).alias("next"), *[x.alias(f"l{k}") for k, x in enumerate(left)], *[x.alias(f"t{k}") for k, x in enumerate(total)]
        )
        lc, tc = ([F.col(f"{s}{k}") for k in range(classes)] for s in "lt")
        rc = [t - x for x, t in zip(lc, tc)]
        n, nl, nr = (sum(c, F.lit(0)) for c in (tc, lc, rc))
        gain = _impurity(tc, impurity) - nl / n * _impurity(lc, impurity) - nr / n * _impurity(rc, impurity)
        fits = (F.col("cut") < F.col("next")) & (gain > 1e-12)
        best = F.max(F.when(fits, F.struct(F.round(gain, 12).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("cut")).alias("c"))))
        nodes = parts.groupBy("bins", "node").agg(best.alias("best"), *[F.max(f"t{k}").alias(f"t{k}") for k in range(classes)]).collect()
        if len(nodes) > most_nodes:
            raise ValueError(f"a level has {len(nodes)} nodes")
        for r in nodes:
            counts = [r[f"t{k}"] for k in range(classes)]
            split = (-r.best.f, -r.best.c) if r.best and level < depth else (None, None)
            found.append((r.bins, r.node, counts.index(max(counts)), *split))
        splits = [(b, n, f, c) for b, n, _, f, c in found if f is not None]
        if level == depth or not any(n.bit_length() == level + 1 for _, n, _, _ in splits):
            break
        here = [s for s in splits if s[1].bit_length() == level + 1]
        now = _down(now, spark.createDataFrame(here, "bins int, node long, feature int, cut int"))
    return found


def sweep(train: DataFrame, test: DataFrame, columns: list[str], label: str, classes: int, depths=(1, 2, 3, 4, 5, 10, 20), bins=(2, 4, 8, 16, 32, 64, 100), depth_bins: int = 32, bins_depth: int = 10, impurity: str = "entropy") -> DataFrame:
    """(parameter, value, rmsle): test error by depth with ``depth_bins`` bins, and by bins at depth ``bins_depth``.

    All trees grow together, as deep as the deepest; labels are classes from 0. Feature values and labels must not be null.
    """
    spark = train.sparkSession
    every = sorted({*bins, depth_bins})
    cuts = fine_cuts(train, columns, max(every))
    rows = session.materialise(_cells(train, columns, cuts, label, every), "cells")
    nodes = grow(rows, cuts, classes, every, max(*depths, bins_depth), impurity)
    table = spark.createDataFrame([(b, n, p) for b, n, p, _, _ in nodes], "bins int, node long, prediction int")
    now = _cells(test, columns, cuts, label, every).withColumn("open", F.lit(True))
    levels = max(n.bit_length() for _, n, _, _, _ in nodes) - 1
    sums = []
    # one pass over the test rows: their node at every level, and its prediction's error
    now = now.withColumn("errors", F.array().cast("array<double>"))
    for level in range(levels + 1):
        at = now.join(F.broadcast(table), ["bins", "node"], "left")  # a row per node
        gap = F.log1p(F.col("prediction")) - F.log1p(F.col("label"))
        now = at.withColumn("errors", F.array_append("errors", gap * gap)).drop("prediction")
        here = [(b, n, f, c) for b, n, _, f, c in nodes if f is not None and n.bit_length() == level + 1]
        if here:
            kept = now.select("cells", "label", "bins", "node", "errors")
            moved = kept.join(F.broadcast(spark.createDataFrame(here, "bins int, node long, feature int, cut int")), ["bins", "node"], "left")
            side = F.when(F.get("cells", F.col("feature")) > F.col("cut"), 1).otherwise(0)
            now = moved.select("cells", "label", "bins", F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.col("node") * 2 + side).alias("node"), "errors")
        sums.append(F.sqrt(F.avg(F.get("errors", F.lit(level)))).alias(f"d{level}"))
    errors = {r.bins: r for r in now.groupBy("bins").agg(*sums).collect()}  # a row per tree
    out = [("depth", d, errors[depth_bins][f"d{min(d, levels)}"]) for d in depths]
    out += [("bins", b, errors[b][f"d{min(bins_depth, levels)}"]) for b in bins]
    return spark.createDataFrame(out, "parameter string, value int, rmsle double")
