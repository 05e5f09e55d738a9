"""Writers: the label store, overwrites, day replacement, text and JDBC exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session

LABEL_COLUMNS = ("entity_id", "family", "label", "value", "num")


def write_labels(labels: DataFrame, path: str, replaced: list[tuple[str, str]] | None = None) -> None:
    """Replace the given labels in the store and leave all others as they are.

    One folder per (family, label). The rebalance lets adaptive execution split a
    large label over tasks and files and pack small ones together. ``replaced`` names
    the (family, label) pairs that were computed: those without rows now are emptied.
    """
    standing = files_of(labels.sparkSession, [f"{path}/family={escaped(family)}/label={escaped(label)}" for family, label in replaced or []])
    (
        labels.select(*LABEL_COLUMNS)
        .hint("rebalance", F.col("family"), F.col("label"))
        .sortWithinPartitions("family", "label", "entity_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("family", "label")
        .parquet(path)
    )
    empty_unless_written(labels.sparkSession, standing)


def files_of(spark: SparkSession, folders: list[str]) -> dict[str, list[str]]:
    return {f: session.names(spark, f) for f in folders}


def empty_unless_written(spark: SparkSession, standing: dict[str, list[str]]) -> None:
    """Delete the folders whose files are still those from before a write: it had no rows for them. The written files tell, nothing is computed again."""
    for folder, files in standing.items():
        if files and session.names(spark, folder) == files:  # every write names its files anew
            session.remove(spark, folder)


def escaped(name: str) -> str:
    """A value as Spark writes it in a folder name."""
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\\x7f{[]^" or c < " " else c for c in name)


def read_labels(spark: SparkSession, path: str, family: str | None = None, labels: list[str] | None = None) -> DataFrame:
    """Label rows; family and label prune folders."""
    df = spark.read.parquet(path)
    if family is not None:
        df = df.where(F.col("family") == family)
    if labels is not None:
        df = df.where(F.col("label").isin(*labels))
    return df.select(*LABEL_COLUMNS)


def wide(labels: DataFrame, names: list[str], numbers: dict[str, float] | None = None, key: str = "entity_id") -> DataFrame:
    """One row per entity with the named cells; ``numbers`` gives numeric cells and their defaults."""
    numbers = numbers or {}

    def cell(n):
        if n in numbers:
            return F.coalesce(F.max(F.when(F.col("label") == n, F.col("num"))), F.lit(float(numbers[n]))).alias(n)
        return F.max(F.when(F.col("label") == n, F.col("value"))).alias(n)

    return labels.where(F.col("label").isin(*names)).groupBy(key).agg(*[cell(n) for n in names])


def replace_days(df: DataFrame, path: str, day: str = "day_id", days: list[str] | None = None) -> None:
    """Replace only the days present in ``df``, and empty those of ``days`` that it has no rows for."""
    standing = files_of(df.sparkSession, [f"{path}/{day}={escaped(each)}" for each in days or []])
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    empty_unless_written(df.sparkSession, standing)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def empty(df: DataFrame, path: str) -> None:
    """Leave a table with its schema and no rows."""
    overwrite(df.limit(0), path)


def overwrite_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def text_lines(df: DataFrame, sep: str = ";") -> DataFrame:
    """All columns glued; NULL and the word 'null' become empty."""
    cells = [F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("null")), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(sep, *cells).alias("value"))


def write_text(df: DataFrame, path: str, sep: str = ";", files: int | None = None) -> None:
    """Delimited text export, in as many files as the result has partitions unless ``files`` asks for fewer."""
    lines = text_lines(df, sep)
    (lines if files is None else lines.coalesce(files)).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, files: int | None = None, sep: str = ",") -> None:
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").csv(path, header=True, sep=sep, nullValue="")


def jdbc_write_options(options: dict[str, str], batch: int = 1000) -> dict[str, str]:
    """Overwrite that keeps the table definition."""
    return {**options, "truncate": "true", "batchsize": str(batch)}


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "overwrite") -> None:
    df.write.format("jdbc").options(**jdbc_write_options(options)).mode(mode).save()


def keyed(df: DataFrame, key: str, value: str, seconds: int = 600, at=None) -> DataFrame:
    """Values with a lifetime: key, value, written_at, expires_at. ``at``: event time, else the time of writing."""
    at = F.current_timestamp() if at is None else at
    rows = df.select(F.col(key).alias("key"), F.col(value).alias("value"), at.cast("timestamp").alias("written_at"))
    return rows.withColumn("expires_at", F.col("written_at") + F.expr(f"INTERVAL {int(seconds)} SECONDS"))


def write_keyed(df: DataFrame, path: str, key: str, value: str, seconds: int = 600, at=None) -> None:
    """Append latest values with a lifetime."""
    keyed(df, key, value, seconds, at).write.mode("append").parquet(path)


def read_keyed(spark: SparkSession, path: str, as_of) -> DataFrame:
    """Latest unexpired value per key."""
    live = spark.read.parquet(path).where((F.col("expires_at") > as_of) & (F.col("written_at") <= as_of))
    return live.groupBy("key").agg(F.max_by("value", F.struct("written_at", "value")).alias("value"))
