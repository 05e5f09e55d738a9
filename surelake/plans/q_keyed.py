"""Streams with lifetimes, replays and late rows. The events arrive in files, one per batch, in the order they are written."""

from functools import reduce

from pyspark.sql import functions as F

from .. import session
from ..streaming import jobs as J
from ..streaming import keyed as K
from .catalog import query

#: First days of the files of a month.
CUTS = (1, 8, 16, 23, 32)


def _files(v, parts):
    """A stream whose files hold the given rows, in order."""
    folder = session.scratch(v.spark, "arrivals")
    for n, rows in enumerate(parts):
        rows.coalesce(1).write.parquet(f"{folder}/{n:03d}")
    return folder, J.file_messages(v.spark, f"{folder}/*", "*.parquet", parts[0].schema, files_per_batch=1)


def _weeks(rows):
    return [rows.where(F.dayofmonth("ts").between(a, b - 1)) for a, b in zip(CUTS, CUTS[1:])]


def _lifetime(v):
    rows = v.events.select((F.col("user_id") % 200).cast("string").alias("key"), F.format_string("%s-%s", "event_type", F.col("event_id").cast("string")).alias("value"), "ts")
    end = v.events.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts")).select(F.lit("~end").alias("key"), F.lit("").alias("value"), "ts")
    after = end.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    _, stream = _files(v, [*_weeks(rows), end, after])
    out, check = session.scratch(v.spark, "lives"), session.scratch(v.spark, "checkpoint")
    K.run_lifetimes(stream.withColumnRenamed("ts", "written_at"), out, check).awaitTermination()
    told = v.spark.read.parquet(out).where("state = 'expired' AND key <> '~end'")
    return told.groupBy("key").agg(F.max(F.struct("written_at", "value", "expires_at")).alias("s")).select(
        "key", "s.value", *[F.col(f"s.{c}").cast("timestamp_ntz").alias(c) for c in ("written_at", "expires_at")])


query("stream_lifetime", """
WITH r AS (SELECT cast(user_id % 200 AS varchar) AS key, concat(event_type, '-', event_id) AS value, date_trunc('millisecond', ts) AS ts FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, value DESC) AS k FROM r)
SELECT key, value, ts AS written_at, ts + INTERVAL 600 SECOND AS expires_at FROM o WHERE k = 1""")(_lifetime)


def _replay(v):
    """Every file comes twice, the second time after the next one; some rows of the first come only when it is far too late."""
    rows = v.events.select(F.col("event_id").alias("id"), F.col("ts").alias("event_time"), "ts", "event_type")
    held = (F.dayofmonth("ts") < CUTS[1]) & (F.col("id") % 50 == 0)
    one, two, three, four = _weeks(rows)
    parts = [one.where(~held), two, one.where(~held), three, two, one, four, three, four]
    given, stream = _files(v, parts)
    out, late = session.scratch(v.spark, "once"), session.scratch(v.spark, "late")
    K.run_once(stream, out, session.scratch(v.spark, "checkpoint"), "2 hours").awaitTermination()
    K.write_late(v.spark.read.schema(rows.schema).parquet(f"{given}/*"), out, late)
    told = [v.spark.read.parquet(f).select("id", "event_type", F.lit(name).alias("status")) for f, name in ((out, "taken"), (late, "late"))]
    return reduce(lambda a, b: a.unionByName(b), told)


query("stream_replay", f"""
SELECT event_id AS id, event_type, CASE WHEN day(ts) < {CUTS[1]} AND event_id % 50 = 0 THEN 'late' ELSE 'taken' END AS status FROM events""")(_replay)
