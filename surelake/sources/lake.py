"""Stored tables laid out for the reads that come: buckets for joins on one key, days for the newest day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int = 200) -> DataFrame:
    """The table, stored at ``path`` in buckets of the key, sorted by it. Tables with as many buckets of one key join and count by it without a shuffle.

    Rows are dealt to the buckets first, so that each is one file. Null keys share a bucket.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def policy_counts(policy: DataFrame, insured: DataFrame, claims: DataFrame) -> DataFrame:
    """policy_id, persons (distinct), rows, claims of every policy; without a shuffle if all three are bucketed by policy_id."""
    people = insured.groupBy("policy_id", "insured_cert_no").agg(F.count("*").alias("n"))
    people = people.groupBy("policy_id").agg(F.count("insured_cert_no").alias("persons"), F.sum("n").alias("rows"))
    filed = claims.groupBy("policy_id").agg(F.count("*").alias("claims"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return policy.select("policy_id").join(people, "policy_id", "left").join(filed, "policy_id", "left").select("policy_id", zero("persons"), zero("rows"), zero("claims"))


def write_days(df: DataFrame, path: str, by: str = "day_id") -> None:
    """Rows in a folder per day."""
    df.repartition(by).write.mode("overwrite").partitionBy(by).parquet(path)


def read_days(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table of ``write_days``; with its schema given, no file is opened before it is asked for."""
    return spark.read.schema(schema).parquet(path)


def on_newest_day(facts: DataFrame, calendar: DataFrame, as_of: str, by: str = "day_id") -> DataFrame:
    """Facts of the newest day of the calendar up to a date. The day is found while the query runs, and only its folder is read."""
    newest = calendar.where(F.col(by) <= F.lit(as_of)).agg(F.max(by).alias(by))
    return facts.join(F.broadcast(newest), by, "left_semi")  # one row
