"""Exact distinct persons from stored bitmaps.

Persons get dense numbers once, those of one enterprise next to each other, so an enterprise fills few
bitmaps of 64 numbers each. One table holds a bitmap, a long, per enterprise, month in which cover began and block of
numbers; distinct persons of any group of enterprises and months are the bits of the bitmaps put
together, block by block, and person rows are not read again. A large enterprise or channel is spread over its blocks,
a small one takes no more room than its persons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import session
from ..functions import scalars as S

#: Who is counted: on valid policies, in force on them, in force on running policies.
MEASURES = ("ever", "active", "now")
#: A block is the numbers equal but for so many last bits: those that fit a long.
BLOCK_BITS = 6


def _owned(policy: DataFrame) -> DataFrame:
    named = S.not_blank("ent_id")
    return policy.where(named).select(
        "policy_id", "ent_id", F.coalesce(S.valid_policy(), F.lit(False)).alias("valid"), F.coalesce(F.col("policy_status") == "1", F.lit(False)).alias("running")
    )


def number_persons(persons: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(person, number) of the distinct persons of (person, home): dense from 0, ordered by home and person.

    With ``known`` numbers, only new persons get one, after the largest; the result holds both. Every range of persons is
    numbered by one task; the offsets are one row per range.
    """
    each = persons.where(F.col("person").isNotNull()).groupBy("person").agg(F.min("home").alias("home"))
    if known is not None:
        each = each.join(known.select("person"), "person", "left_anti")
    dealt = each.repartitionByRange("home", "person").sortWithinPartitions("home", "person")
    # the upper bits of the id name the range, the lower 33 the place in it; written down, they stay as they are
    placed = session.materialise(dealt.select("person", F.monotonically_increasing_id().alias("at")), "persons")
    placed = placed.select("person", F.shiftright("at", 33).alias("range"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    sizes = [(r["range"], r["count"]) for r in placed.groupBy("range").count().orderBy("range").collect()]  # one row per task
    last = None if known is None else known.agg(F.max("number")).first()[0]
    first, rows = 0 if last is None else last + 1, []
    for part, n in sizes:
        rows.append((part, first))
        first += n
    firsts = persons.sparkSession.createDataFrame(rows, "range long, first long")
    out = placed.join(F.broadcast(firsts), "range").select("person", (F.col("first") + F.col("place")).alias("number"))  # one row per task
    return out if known is None else known.select("person", "number").unionByName(out)


def person_bitmaps(policy: DataFrame, insured: DataFrame, started: DataFrame, numbers: DataFrame) -> DataFrame:
    """(ent_id, month_id, block, ever, active, now): bitmaps of the persons, by the month their cover began.

    ``insured``: policy_id, insured_id, insured_cert_no, insure_policy_status. ``started``: insured_id, insured_start_date; rows without one
    have a null month. ``numbers``: person, number. Repeated rows of a person set the same bit.
    """
    live = F.coalesce(F.col("insure_policy_status") == "1", F.lit(False))
    begun = started.groupBy("insured_id").agg(F.min("insured_start_date").alias("first"))
    rows = insured.where(F.col("insured_cert_no").isNotNull()).join(begun, "insured_id", "left")
    rows = rows.select("policy_id", F.col("insured_cert_no").alias("person"), F.date_format("first", "yyyyMM").alias("month_id"), live.alias("live"))
    counted = {"ever": F.col("valid"), "active": F.col("valid") & F.col("live"), "now": F.col("running") & F.col("live")}
    bit = F.expr(f"shiftleft(1L, cast(number & {(1 << BLOCK_BITS) - 1} AS int))")
    placed = rows.join(_owned(policy), "policy_id").join(numbers.select("person", "number"), "person").select(
        "ent_id", "month_id", F.shiftright("number", BLOCK_BITS).alias("block"), *[F.when(counted[m], bit).otherwise(F.lit(0).cast("long")).alias(m) for m in MEASURES]
    )
    return placed.groupBy("ent_id", "month_id", "block").agg(*[F.bit_or(m).alias(m) for m in MEASURES])


def write_bitmaps(bitmaps: DataFrame, path: str) -> None:
    """The stored table, a folder per month, so that a period reads only its months. A task writes few months, so there are few files."""
    bitmaps.repartitionByRange("month_id", "ent_id", "block").sortWithinPartitions("month_id", "ent_id", "block").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month_id").parquet(path)


def distinct_persons(bitmaps: DataFrame, *by: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Distinct persons per group of the columns ``by``: bitmaps are put together per block, then their bits are added up."""
    blocks = bitmaps.groupBy(*by, "block").agg(*[F.bit_or(m).alias(m) for m in measures])
    return blocks.groupBy(*by).agg(*[F.sum(F.bit_count(m)).alias(m) for m in measures])


def channel_persons(bitmaps: DataFrame, members: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Distinct persons per channel; a person of several of its enterprises counts once. ``members``: ent_id, channel."""
    own = members.select("ent_id", "channel").where(F.col("channel").isNotNull()).distinct()
    return distinct_persons(bitmaps.join(own, "ent_id"), "channel", measures=measures)


def shared_persons(bitmaps: DataFrame, left: Column, right: Column, measure: str = "ever") -> DataFrame:
    """Persons in both of two sets of enterprises (conditions on the bitmap rows), by adding and subtracting the counts of their unions."""
    either = distinct_persons(bitmaps.where(left | right).withColumn("all", F.lit(1)), "all", measures=(measure,))
    one = distinct_persons(bitmaps.where(left).withColumn("all", F.lit(1)), "all", measures=(measure,))
    two = distinct_persons(bitmaps.where(right).withColumn("all", F.lit(1)), "all", measures=(measure,))
    counts = one.select(F.col(measure).alias("n")).unionByName(two.select(F.col(measure).alias("n"))).unionByName(either.select((-F.col(measure)).alias("n")))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("shared"))
