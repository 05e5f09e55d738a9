"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings the operators are written for. AQE splits skewed join partitions and
#: sizes shuffle partitions at run time, so no partition count is wired in.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build(master: str | None = None, app: str = "surelake", **extra: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


#: Bytes of stored input that one shuffle partition takes, of shuffled data that adaptive execution puts into one task, and of files
#: that one task reads. Stored rows unfold to some fifty times their size in the sorts and hash tables of a task.
INPUT_PER_PARTITION, SHUFFLED_PER_TASK, SKEWED, READ_PER_TASK = 4 << 20, 4 << 20, 32 << 20, 16 << 20


def tune(spark: SparkSession, folder: str | None = None) -> None:
    """Let adaptive execution split skewed joins in a session built elsewhere.

    With the ``folder`` of the inputs, shuffles get as many partitions as its size asks for, so that a task's
    share, and the memory it takes, stays the same when the input grows. A task that reads files takes a bounded part
    of them, as what it counts before a shuffle is held in a hash table. Smaller limits of the session are kept.
    """
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(k, "true")
    if folder is not None:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shares(spark, folder))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
        in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        limits = {"adaptive.advisoryPartitionSizeInBytes": SHUFFLED_PER_TASK, "adaptive.skewJoin.skewedPartitionThresholdInBytes": SKEWED, "files.maxPartitionBytes": READ_PER_TASK}
        for k, most in limits.items():
            if in_bytes(spark.conf.get(f"spark.sql.{k}")) > most:
                spark.conf.set(f"spark.sql.{k}", str(most))


def shares(spark: SparkSession, folder: str) -> int:
    """Partitions that the size of the inputs asks for."""
    return -(-stored(spark, folder) // INPUT_PER_PARTITION)


def stored(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path of any file system Spark can read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="surelake-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_scopes = threading.local()
_registered: set[str] = set()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark can write to, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name, which must be free."""
    source = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(source, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system Spark can read; none if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system Spark can read is a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def _remove_quietly(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # noqa: BLE001  the JVM may be gone at the end of the process
        pass


def _application_folder(spark: SparkSession) -> str:
    folder = f"{shared_dir(spark)}/surelake/{spark.sparkContext.applicationId}"
    if folder not in _registered:
        _registered.add(folder)
        atexit.register(_remove_quietly, spark, folder)
    return folder


@contextmanager
def scope(spark: SparkSession):
    """Scratch tables written inside (by this thread) are removed at its end."""
    folder = f"{getattr(_scopes, 'folder', None) or _application_folder(spark)}/scope-{uuid.uuid4().hex}"
    before, _scopes.folder = getattr(_scopes, "folder", None), folder
    try:
        yield folder
    finally:
        _scopes.folder = before
        remove(spark, folder)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder. It lasts as long as the scope, else the application."""
    return f"{getattr(_scopes, 'folder', None) or _application_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that write inside delete their shuffle files as they end, not when the driver happens to collect its garbage.

    Only for writes: their plan is run once.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialise(df, name: str, path: str | None = None):
    """Write a table that several jobs reuse and read it back. ``path``: a ``scratch`` taken before a scope, for a table that outlasts it.

    Unlike a cache this survives lost executors; unlike a localCheckpoint it
    lives in the shared folder. What was shuffled for it is deleted with its end.
    """
    spark = df.sparkSession
    path = path or scratch(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
