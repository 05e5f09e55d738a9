"""Exact duplicates by sorting texts and comparing neighbours. DataFrame functions only.

A sample of the rows gives splitters; every row goes to the bucket between two splitters and is
sorted there externally, so equal texts stand next to each other and each is compared in full with
the one before it. The sort key ends in length and id, so a text with very many copies is cut over
as many buckets as its share of the rows; the runs at bucket edges are joined up afterwards from
two rows per bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surelake import session
from surelake.llm.common import shuffle_partitions, text_of

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, "")


def sort_key(norm: Column, points: Column, doc_id: Column) -> Column:
    """First bytes of the text, its digest, then length and id: equal texts are adjacent, large groups divisible."""
    return F.concat_ws(
        "!", F.hex(F.encode(F.substring(norm, 1, 12), "UTF-8")), F.sha2(norm.cast("binary"), 256), points.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("~"))
    )


def bucket_of(key: Column, splitters: list[str]) -> Column:
    """How many splitters are at most the key, by halving steps over the sorted splitters."""
    if not splitters:
        return F.lit(0)
    known = F.array(*[F.lit(s) for s in splitters]) if len(splitters) < 64 or any("\n" in s for s in splitters) else F.split(F.lit("\n".join(splitters)), "\n")
    steps = F.array(*[F.lit(1 << k) for k in range(len(splitters).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(known, at + step - 1) <= key, at + step).otherwise(at))


def mark_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = 64 << 20, sample_per_bucket: int = 30, most_buckets: int = 20_000
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_points.

    Texts are equal when the same without ``SPACES``; a null text counts as empty. The row with the
    most code points, then the smallest id, stays; a null id comes last. Of rows equal in text and id
    exactly one has ``kept``. An empty table gives no rows. Other columns are not read.
    ``most_buckets`` bounds the number of splitters held by the driver; a larger bucket only sorts on disk longer.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    rows, size = base.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = min(most_buckets, max(shuffle_partitions(spark), math.ceil(size / bucket_bytes)))

    def keyed(df: DataFrame) -> DataFrame:
        plain = df.select("doc_id", F.char_length("text").alias("n_points"), normalised(F.col("text")).alias("norm"))
        return plain.withColumn("key", sort_key(F.col("norm"), F.col("n_points"), F.col("doc_id")))

    share = min(1.0, buckets * sample_per_bucket / max(rows, 1))
    sample = sorted({r.key for r in keyed(base.sample(False, share, 7) if share < 1 else base).select("key").collect()})
    splitters = sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []

    order = Window.partitionBy("bucket").orderBy("key")
    placed = keyed(base).withColumn("bucket", bucket_of(F.col("key"), splitters)).repartitionById(len(splitters) + 1, F.col("bucket"))
    compared = placed.select(
        "doc_id", "n_points", "bucket", "key", F.split_part(F.col("key"), F.lit("!"), F.lit(2)).alias("text_sha256"), "norm",
        (~F.lag("norm").over(order).eqNullSafe(F.col("norm"))).alias("begins"),
        (~F.lag("key").over(order).eqNullSafe(F.col("key"))).alias("fresh"),
        F.lag("key").over(order).isNull().alias("is_first"),
        F.lead("key").over(order).isNull().alias("is_last"),
    )
    edge = F.when(F.col("is_first") | F.col("is_last"), F.col("norm"))
    runs = compared.select(
        "doc_id", "n_points", "bucket", "text_sha256", "fresh", "is_first", "is_last", edge.alias("edge_text"),
        F.sum(F.col("begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
    )
    group = Window.partitionBy("bucket", "run")
    rank = F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    local = session.materialise(runs.withColumn("best", F.min(rank).over(group)).withColumn("size", F.count(F.lit(1)).over(group)), "exact-runs")
    known = local.join(F.broadcast(chains(local)), ["bucket", "run"], "left")  # two rows per bucket at most
    best = F.coalesce("chain_best", "best")
    return known.select(
        "doc_id", best["id"].alias("keep_id"), F.coalesce("chain_size", "size").alias("group_size"),
        (F.col("fresh") & (best["n"] == -F.col("n_points")) & best["id"].eqNullSafe(F.col("doc_id"))).alias("kept"),
        "text_sha256", "n_points",
    )


def chains(local: DataFrame) -> DataFrame:
    """Runs that go on from one bucket into the next: (bucket, run) -> best row and size of the whole chain."""
    first = local.where("is_first").select("bucket", "run", "edge_text", "best", "size")
    last = local.where("is_last").select("bucket", "run", "edge_text", "best", "size")
    before = last.select((F.col("bucket") + 1).alias("bucket"), F.col("edge_text").alias("before_text"))
    first = first.join(before, "bucket", "left").select("bucket", "run", "best", "size", F.col("edge_text").eqNullSafe(F.col("before_text")).alias("goes_on"))
    last = last.where("run > 1").select("bucket", "run", "best", "size", F.lit(False).alias("goes_on"))
    pieces = first.unionByName(last).withColumn("chain", F.sum((~F.col("goes_on")).cast("int")).over(Window.orderBy("bucket", "run")))
    whole = Window.partitionBy("chain")
    out = pieces.select("bucket", "run", F.min("best").over(whole).alias("chain_best"), F.sum("size").over(whole).alias("chain_size"), F.count(F.lit(1)).over(whole).alias("parts"))
    return out.where("parts > 1").drop("parts")


def keep_unique(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of repeated rows with one id and text the first by the other columns.

    Nulls, empty and long texts and ties as in ``mark_duplicates``. Columns may have any names; an empty table gives no rows.
    """
    stays = mark_duplicates(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"), F.col("n_points").alias("n"))
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{doc_id}`").alias("id"),
        F.sha2(normalised(text_of(f"`{text}`")).cast("binary"), 256).alias("sha"), F.char_length(text_of(f"`{text}`")).alias("n"),
    )
    joined = own.join(stays, [own[k].eqNullSafe(stays[k]) for k in ("id", "sha", "n")], "left_semi")
    order = F.struct(*[F.col(f"row.`{c}`").cast("string") for c in docs.columns if c != text] or [F.lit(0)])
    return joined.groupBy("id", "sha", "n").agg(F.min_by("row", order).alias("row")).select("row.*")
