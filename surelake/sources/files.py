"""File, table and JDBC readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_text(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header row, every column text, quotes stripped."""
    return spark.read.csv(path, header=True, inferSchema=False, sep=sep, quote='"', escape='"')


def csv_exact(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """CSV rows that have exactly the given number of fields; the others are dropped."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + [T.StructField("_bad", T.StringType())])
    rows = spark.read.csv(path, header=header, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=True)
    return rows.where(F.col("_bad").isNull()).drop("_bad")


def text_lines(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.text(glob)


def blocks(df: DataFrame, column: str, keys: list[str], separator: str = "\\n\\n") -> DataFrame:
    """Records of a text split on a separator, blank ones dropped, numbered from 0."""
    parts = F.filter(F.split(F.col(column), separator), lambda x: x.rlike("\\S"))
    return df.select(*keys, F.posexplode(parts).alias("block", "record"))


def text_blocks(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, record): records of files, parted by empty lines and numbered from 0 in each file.

    Files are read line by line, so a large one is read by many tasks. A record that goes on in the next part of its file is known from one row
    per part: whether it begins and ends inside a record, and how many begin in it. Only the lines of one record meet.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("place"), F.col("value").alias("line")
    )
    order = Window.partitionBy("file", "part").orderBy("place")
    lines = lines.withColumn("empty", F.col("line") == "").withColumn("after_empty", F.lag("empty").over(order))
    begins = ~F.col("empty") & F.coalesce("after_empty", F.lit(True))
    parts = lines.groupBy("file", "part").agg(
        F.count_if(begins).alias("n"), F.min_by("empty", "place").alias("first_empty"), F.max_by("empty", "place").alias("last_empty")
    )
    by_file = Window.partitionBy("file").orderBy("part")
    parts = parts.withColumn("fresh", F.coalesce(F.lag("last_empty").over(by_file), F.lit(True)))
    own = F.col("n") - (~F.col("first_empty") & ~F.col("fresh")).cast("int")
    parts = parts.select("file", "part", "fresh", F.coalesce(F.sum(own).over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    starts = (~F.col("empty") & F.coalesce("after_empty", "fresh")).cast("int")
    numbered = lines.join(parts, ["file", "part"]).withColumn("block", F.col("before") + F.sum(starts).over(order) - 1).where(~F.col("empty"))
    text = F.transform(F.array_sort(F.collect_list(F.struct("part", "place", "line"))), lambda x: x["line"])
    return numbered.groupBy("file", "block").agg(F.array_join(text, "\n").alias("record"))


# --------------------------------------------------------------------- JDBC


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None, driver: str | None = None,
                 fetch_size: int = 10000) -> dict[str, str]:
    """Options of a plain JDBC read or write; secrets come from the caller, never from code."""
    o = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            o[k] = v
    return o


def jdbc_ranges(options: dict[str, str], column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Range-partitioned read; bounds should be the real minimum and maximum of the column."""
    return {**options, "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}


def jdbc_subquery(options: dict[str, str], condition: str) -> dict[str, str]:
    """Let the database filter: the table becomes a filtered subquery."""
    return {**options, "dbtable": f"(SELECT * FROM {options['dbtable']} WHERE {condition}) AS t1"}


def jdbc_bounds(spark: SparkSession, options: dict[str, str], column: str) -> tuple[int, int]:
    """Smallest and largest value of the partition column, asked from the database."""
    q = f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {options['dbtable']}) AS b"
    row = spark.read.format("jdbc").options(**{**options, "dbtable": q}).load().first()
    return (int(row["lo"] or 0), int(row["hi"] or 0))


def read_jdbc(spark: SparkSession, options: dict[str, str], column: str | None = None, partitions: int = 10) -> DataFrame:
    """One partition, or ``partitions`` ranges of a numeric column with asked bounds."""
    if column is not None:
        lo, hi = jdbc_bounds(spark, options, column)
        options = jdbc_ranges(options, column, lo, hi + 1, partitions)
    return spark.read.format("jdbc").options(**options).load()
