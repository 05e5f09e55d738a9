"""Daily headcounts kept up from one day's changes.

The store holds, in folders by a hash of the policy, the policies, their persons' spans and the steps of the
headcount, and the daily table in folders by day or month. There a row is a policy's run of days with one headcount, cut at the
ends of the folder's period; ``daily_headcount`` gives the days. A run of the store reads only the buckets of changed policies, computes the
steps of those policies anew, compares them with the stored ones and rewrites the periods that differ. Days are never expanded for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session
from ..functions import scalars as S
from ..sources import sinks
from . import headcount

POLICY = ["policy_id", "policy_code", "start_date", "end_date"]
SPAN = ["policy_id", "insured_id", "insured_cert_no", "insured_start_date", "insured_end_date"]


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64(F.col("policy_id").cast("string")), F.lit(buckets)).cast("int").alias("bucket")


def read_folders(spark: SparkSession, path: str, by: str, values: list, schema) -> DataFrame:
    """Rows of some partition folders; only these are listed and read."""
    there = set(session.names(spark, path))
    found = [f"{path}/{by}={v}" for v in values if f"{by}={v}" in there]
    return spark.read.schema(schema).option("basePath", path).parquet(*found) if found else spark.createDataFrame([], schema)


def _newest(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old`` with those of ``new`` in their place."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def _write(rows: DataFrame, path: str, by: str, values: list) -> None:
    """Replace whole partition folders; those of ``values`` without rows are emptied."""
    sinks.replace_days(rows.repartition(by).sortWithinPartitions(by, "policy_id"), path, by, [str(v) for v in values])


def _merged(steps: DataFrame) -> DataFrame:
    """Steps that follow each other with the same headcount put together, so that equal days have equal rows."""
    w = Window.partitionBy("policy_id").orderBy("first")
    goes_on = (F.date_add(F.lag("last").over(w), 1) == F.col("first")) & (F.lag("n").over(w) == F.col("n")) & (F.lag("policy_code").over(w) == F.col("policy_code"))
    numbered = steps.withColumn("opens", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("opens").over(w))
    runs = numbered.groupBy("policy_id", "policy_code", "n", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.select("policy_id", "policy_code", "first", "last", "n")


#: digits of a day that name its folder: the SQL unit and its months
UNITS = {8: ("DAY", 0), 6: ("MONTH", 1), 4: ("YEAR", 12)}


def _by_period(steps: DataFrame, digits: int) -> DataFrame:
    """Steps cut at the ends of days, months or years: policy_id, policy_code, first, last, n, period."""
    unit, months = UNITS[digits]
    begin = F.trunc("first", unit) if months else F.col("first")
    cut = steps.withColumn("start", F.explode(F.sequence(begin, F.col("last"), F.expr(f"INTERVAL 1 {unit}"))))
    end = F.date_sub(F.add_months("start", months), 1) if months else F.col("start")
    return cut.select(
        "policy_id", "policy_code", F.greatest("first", "start").alias("first"), F.least(F.col("last"), end).alias("last"), "n",
        F.substring(S.day_id("start"), 1, digits).alias("period"),
    )


def apply_changes(spark: SparkSession, path: str, policy: DataFrame, insured: DataFrame, buckets: int = 256, digits: int = 8) -> dict:
    """Bring the store up to date; says how many policies changed, which buckets were read and which folders of days were rewritten.

    ``digits`` of the day name a folder of the daily table: 8 a day, 6 a month, for changes that reach over years.

    ``policy``: new and changed policies (``POLICY``), each once; a null code removes the policy. ``insured``: new and changed person rows
    (``SPAN``), each (policy, insured_id) once; a null start removes the row. Rows come as often as they like: a run that broke off, or one with
    changes already known, is simply repeated, as the days are written first and the rows they follow from last.
    """
    with session.scope(spark):
        policy = policy.select(*POLICY).withColumns({c: S.day(c) for c in POLICY[2:]})
        insured = insured.select(*SPAN).withColumns({c: S.day(c) for c in SPAN[3:]})
        policy, insured = (session.materialise(d.withColumn("bucket", bucket_of(buckets)), "changes") for d in (policy, insured))
        touched = session.materialise(policy.select("policy_id", "bucket").unionByName(insured.select("policy_id", "bucket")).distinct(), "touched")
        hit = sorted(r.bucket for r in touched.select("bucket").distinct().collect())  # at most ``buckets``
        if not hit:
            return {"policies": 0, "buckets": [], "days": []}
        steps_schema = policy.select("policy_id", "policy_code", F.col("start_date").alias("first"), F.col("end_date").alias("last"), F.lit(0).cast("long").alias("n"), "bucket").schema
        old_policy, old_spans, old_steps = (read_folders(spark, f"{path}/{t}", "bucket", hit, s) for t, s in (("policies", policy.schema), ("spans", insured.schema), ("steps", steps_schema)))
        policies = session.materialise(_newest(old_policy, policy, ["policy_id"]).where("policy_code IS NOT NULL"), "policies")
        spans = session.materialise(_newest(old_spans, insured, ["policy_id", "insured_id"]).where("insured_start_date IS NOT NULL"), "spans")

        ours = touched.select("policy_id")
        fresh = headcount.headcount_steps(policies.join(ours, "policy_id", "left_semi"), spans.join(ours, "policy_id", "left_semi"))
        fresh = _merged(fresh.withColumn("n", F.col("n").cast("long")))
        fresh = session.materialise(fresh.withColumn("bucket", bucket_of(buckets)), "steps")
        stale = old_steps.join(ours, "policy_id", "left_semi")

        was, now = _by_period(stale, digits), _by_period(fresh, digits)
        differ = was.withColumn("k", F.lit(-1)).unionByName(now.withColumn("k", F.lit(1))).groupBy(*now.columns).agg(F.sum("k").alias("k"))
        changed = sorted(r.period for r in differ.where("k <> 0").select("period").distinct().collect())  # periods of a calendar
        old_daily = read_folders(spark, f"{path}/daily", "period", changed, now.schema)
        daily = old_daily.join(ours, "policy_id", "left_anti").select(*now.columns).unionByName(now.where(F.col("period").isin(changed)))
        kept = old_steps.join(ours, "policy_id", "left_anti").select(*fresh.columns).unionByName(fresh)
        kept = session.materialise(kept, "steps")
        if changed:
            daily = session.materialise(daily, "daily")
            _write(daily, f"{path}/daily", "period", changed)
        for name, rows in (("steps", kept), ("spans", spans), ("policies", policies)):
            _write(rows, f"{path}/{name}", "bucket", hit)
        return {"policies": touched.count(), "buckets": hit, "days": changed}


def daily_headcount(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """The kept daily table (policy_id, policy_code, day_id, curr_insured), or some of its days."""
    table = spark.read.parquet(f"{path}/daily")
    if days is not None:
        digits = max(len(n.split("=")[-1]) for n in session.names(spark, f"{path}/daily") if "=" in n)
        table = table.where(F.col("period").cast("string").isin(sorted({d[:digits] for d in days})))
    table = table.select("policy_id", "policy_code", "n", F.explode(S.days("first", "last")).alias("day"))
    table = table.select("policy_id", "policy_code", S.day_id("day").alias("day_id"), F.col("n").alias("curr_insured"))
    return table if days is None else table.where(F.col("day_id").isin(days))
