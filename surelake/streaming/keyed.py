"""Keyed streams that forget: results with a lifetime, and messages that come again or too late."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import session
from . import jobs

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: A result as it is told: when it comes (``live``) and when it runs out (``expired``).
LIFE = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("value", T.StringType()), T.StructField("written_at", T.TimestampType()),
    T.StructField("expires_at", T.TimestampType()), T.StructField("state", T.StringType()),
])
_HELD = T.StructType([T.StructField("value", T.StringType()), T.StructField("written_ms", T.LongType())])


class Lifetime(StatefulProcessor):
    """Keeps the newest value of a key until its time runs out; a newer value begins a new time."""

    def __init__(self, seconds: int):
        self.ms = seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _HELD)

    def _row(self, key, value, written, state):
        import pandas as pd

        at = pd.Timestamp(written, unit="ms")
        return pd.DataFrame({"key": [key[0]], "value": [value], "written_at": [at], "expires_at": [at + pd.Timedelta(milliseconds=self.ms)], "state": [state]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        old = self.held.get() if self.held.exists() else None
        best = None if old is None else (old[1], old[0])
        for part in rows:
            for value, at in zip(part["value"], part["written_at"]):
                one = (int(at.value // 1_000_000), value)
                best = one if best is None or one > best else best
        if old is None or best != (old[1], old[0]):
            if old is not None:
                self.handle.deleteTimer(old[1] + self.ms)
            self.held.update((best[1], best[0]))
            self.handle.registerTimer(best[0] + self.ms)
            yield self._row(key, best[1], best[0], "live")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        if self.held.exists():
            value, written = self.held.get()
            self.held.clear()
            yield self._row(key, value, written, "expired")

    def close(self) -> None:
        pass


def lifetimes(results: DataFrame, seconds: int = 600, delay: str = "0 seconds") -> DataFrame:
    """Rows of ``LIFE`` for a stream of (key, value, written_at). Time is the stream's own: a result expires when the watermark passes its end.

    State per key is one value and one timer. Rows older than the watermark and null keys, values or times are left out.
    """
    known = results.where(F.col("key").isNotNull() & F.col("value").isNotNull() & F.col("written_at").isNotNull())
    return known.select("key", "value", F.col("written_at").cast("timestamp").alias("written_at")).withWatermark("written_at", delay).groupBy("key").transformWithStateInPandas(
        statefulProcessor=Lifetime(seconds), outputStructType=LIFE, outputMode="Append", timeMode="EventTime"
    )


def run_lifetimes(results: DataFrame, folder: str, checkpoint: str, seconds: int = 600, delay: str = "0 seconds", every: str | None = None):
    """Start the job: one folder of rows per batch. Its state lives in the checkpoint, so a restarted job still lets old results expire."""
    conf = results.sparkSession.conf
    before = conf.get(STORE)
    conf.set(STORE, ROCKS)
    try:
        return jobs.run(lifetimes(results, seconds, delay), lambda df, n: jobs.write_batch(df, folder, n), checkpoint, every)
    finally:
        conf.set(STORE, before)  # a started query keeps its own


def live_results(spark: SparkSession, folder: str) -> DataFrame:
    """What has come and not run out, the newest per key."""
    last = jobs.newest_state(spark.read.parquet(folder).withColumn("batch", F.struct("batch", "written_at", (F.col("state") == "expired"))), "key")
    return last.where("state = 'live'").drop("state")


# ------------------------------------------------------------------ replays


def once(messages: DataFrame, delay: str, key: str = "id", at: str = "event_time") -> DataFrame:
    """Messages of a stream without repetitions. One that comes again within ``delay`` of the newest is known by its id, a later one is
    older than the watermark and left out, so the state holds no more than ``delay`` of ids."""
    return messages.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def run_once(messages: DataFrame, folder: str, checkpoint: str, delay: str, key: str = "id", at: str = "event_time", every: str | None = None):
    """Start the job: each message once, a folder per batch."""
    return jobs.run(once(messages, delay, key, at), lambda df, n: jobs.write_batch(df, folder, n), checkpoint, every)


def write_late(given: DataFrame, folder: str, late: str, key: str = "id") -> int:
    """Messages that came too late for the job, each once, into a folder of their own; how many.

    ``given``: all messages that arrived. What the job has taken lies in ``folder``.
    """
    spark = given.sparkSession
    missing = given.where(F.col(key).isNotNull()).join(spark.read.parquet(folder).select(key), key, "left_anti").dropDuplicates([key])
    session.remove(spark, late)
    missing.write.parquet(late)
    return spark.read.parquet(late).count()
