"""Structured Streaming jobs.

Every job takes messages as ``key, value`` text, as a Kafka topic delivers them,
and writes idempotently: a repeated batch replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..operators import matching, model_columns, models, profile
from ..sources import sinks


def kafka_messages(spark: SparkSession, servers: str, topics: str, starting: str = "latest") -> DataFrame:
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting)
        .load()
    )
    return raw.select(F.coalesce(F.col("key").cast("string"), F.col("topic")).alias("key"), F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, folder: str, pattern: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream (rows, not yet messages)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(folder)


def run(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None, mode: str = "append"):
    """Start a job: everything available and stop, or a micro-batch per ``every``.

    The checkpoint holds offsets and state, so a restarted job goes on where it stopped.
    """
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (w.trigger(availableNow=True) if every is None else w.trigger(processingTime=every)).start()


def write_batch(df: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    """Write one batch as its own folder; a retry of the batch replaces all of it, whatever date it is stamped with."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partitions) if partitions else w).parquet(f"{path}/batch={batch_id}")


def compact(spark: SparkSession, folder: str, newest: Callable[[DataFrame], DataFrame], upto: int) -> None:
    """Put the batches up to ``upto`` into one folder holding only what ``newest`` keeps of them.

    The result stands under the number of the last of them, so later batches still come after it. It is written beside
    the batches first and takes the place of the last one by renames; only then do the earlier ones go. A run that stops in
    between loses nothing: ``batches`` and the next run see either the old folders or the new one. Not to be run while the job writes one of
    these batches.
    """
    _finish_swap(spark, folder)
    old = batches(spark, folder).where(F.col("batch") <= upto)
    numbers = sorted(r.batch for r in old.select("batch").distinct().collect())
    if len(numbers) > 1:
        ready, building = f"{folder}/_compacted-{numbers[0]}-{numbers[-1]}", f"{folder}/_building"
        session.remove(spark, building)
        newest(old).drop("batch").write.parquet(building)
        session.rename(spark, building, ready)  # from here on the result counts
        _finish_swap(spark, folder)


def compact_before(spark: SparkSession, folder: str, newest: Callable[[DataFrame], DataFrame], batch_id: int, every: int | None) -> None:
    """``compact`` of all batches before this one, if it is its turn. A batch begins when those before it are complete, so a job may call it first."""
    if every and batch_id and batch_id % every == 0:
        compact(spark, folder, newest, batch_id - 1)


def _with_batch(df: DataFrame) -> DataFrame:
    return df.withColumn("batch", F.lit(0))


def _finish_swap(spark: SparkSession, folder: str) -> None:
    """Put a finished result of ``compact`` in the place of its batches; repeating it does no harm."""
    for name in session.names(spark, folder):
        if name.startswith("_compacted-"):
            low, high = map(int, name.split("-")[1:])
            for other in session.names(spark, folder):
                if other.startswith("batch=") and low <= int(other[6:]) <= high:
                    session.remove(spark, f"{folder}/{other}")
            session.rename(spark, f"{folder}/{name}", f"{folder}/batch={high}")


def batches(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of the batch folders with their batch; a finished result of ``compact`` that has not taken its place yet stands for its batches."""
    ready = [tuple(map(int, n.split("-")[1:])) for n in session.names(spark, folder) if n.startswith("_compacted-")]
    rows = None
    for low, high in ready:
        part = spark.read.parquet(f"{folder}/_compacted-{low}-{high}").withColumn("batch", F.lit(high))
        rows = part if rows is None else rows.unionByName(part)
    for low, high in ready:
        left = [n for n in session.names(spark, folder) if n.startswith("batch=") and not low <= int(n[6:]) <= high]
        if not left:
            return rows
        return spark.read.option("basePath", folder).parquet(*[f"{folder}/{n}" for n in left]).unionByName(rows)
    return spark.read.parquet(folder)


# ------------------------------------------------------------- change routing


def route(messages: DataFrame, targets: dict[str, tuple[str, list[str]]], day: str | None = None) -> dict[str, DataFrame]:
    """Typed rows per target: messages whose key contains the target's word, stamped with the processing date."""
    stamp = F.current_date().cast("string") if day is None else F.lit(day)
    out = {}
    for name, (word, columns) in targets.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        rows = messages.where(F.col("key").contains(word)).select(F.from_json("value", schema).alias("r"))
        out[name] = rows.select("r.*", stamp.alias("month"))
    return out


def route_job(targets: dict[str, tuple[str, list[str]]], folder: str, day: str | None = None):
    def batch(df: DataFrame, batch_id: int) -> None:
        df.persist()
        for name, rows in route(df, targets, day).items():
            write_batch(rows, f"{folder}/{name}", batch_id, "month")
        df.unpersist()

    return batch


# --------------------------------------------------------------- review score

# Field names of the review messages.
REVIEW_FIELDS = (
    "reportHours riskDays preCompensation injury entValueScore entRiskLevel insuredRiskLevel policyPayRate requestId policyId entId insuredCertNo"
).split()
REVIEW_FEATURES = ["reportHours", "riskDays", "preCompensation"]

# Injury codes that always rank highest.
SEVERE = ("I005", "I006")


def parse_reviews(messages: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in REVIEW_FIELDS])
    rows = messages.select(F.from_json("value", schema).alias("r")).select("r.*")
    numbers = {c: F.col(c).try_cast("double") for c in (*REVIEW_FEATURES, "entValueScore", "policyPayRate")}
    return rows.withColumns(numbers).where(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in REVIEW_FEATURES)))


def review_scores(rows: DataFrame) -> DataFrame:
    """Score and conclusion; ``cluster`` is the timeliness cluster (0..2) of the stored model."""
    person = F.col("insuredRiskLevel").try_cast("int")
    person = F.when(person.isin(1, 2), 1).when(person.isin(5, 6), 2).otherwise(3)
    info = F.when(F.col("injury").isin(*SEVERE), 3).otherwise(F.col("cluster") + 1)

    def level(c):
        return F.when(c == 1, 0).when(c == 2, 50).otherwise(100)

    score = level(info) * 0.25 + level(person) * 0.25 + level(F.col("entRiskLevel").try_cast("int")) * 0.30 + F.col("policyPayRate") * 100 * 0.20
    return rows.select(
        "requestId", "policyPayRate", "entRiskLevel", "entValueScore", person.alias("insuredRiskLevel"), info.alias("riskInfoLevel"),
        score.alias("score"), models.band(score - F.col("entValueScore") * 0.10).alias("conclusion"),
    )


def review_job(model, folder: str, seconds: int = 600, at=None):
    """Scores under ``enter_model_res_<request>`` for ten minutes; the stored model, its scaler included, is an expression in the batch's plan."""
    cluster = model_columns.prediction(model)

    def batch(df: DataFrame, batch_id: int) -> None:
        rows = parse_reviews(df).withColumn("cluster", cluster)
        out = review_scores(rows)
        write_batch(answers(out, "enter_model_res_", "requestId", F.to_json(F.struct(*out.columns)), seconds, at), folder, batch_id)

    return batch


def answers(rows: DataFrame, prefix: str, request: str, value, seconds: int = 600, at=None) -> DataFrame:
    """One message per request under its key, with a lifetime. ``at``: fixed time, else that of the batch."""
    now = F.current_timestamp() if at is None else F.lit(at)
    return sinks.keyed(rows.select(F.concat(F.lit(prefix), F.col(request).cast("string")).alias("k"), value.alias("v")), "k", "v", seconds, now)


# -------------------------------------------------------------- keyed profile


def profile_state(rides: DataFrame) -> DataFrame:
    """Running ride facts per person. Counters and first/last rows merge, so state per person has a fixed size;
    the date they are judged at is given when they are read (``profile.ride_behaviour``)."""
    return profile.ride_facts(rides)


def profile_job(folder: str, compact_every: int | None = None, key: str = "insured_cert_no"):
    """The state's new rows, a folder per batch; every so many batches the earlier ones become one with a row per key."""
    def batch(df: DataFrame, batch_id: int) -> None:
        compact_before(df.sparkSession, folder, lambda d: _with_batch(newest_state(d, key)), batch_id, compact_every)
        write_batch(df, folder, batch_id)

    return batch


def newest_state(df: DataFrame, key: str) -> DataFrame:
    """The row of the newest batch per key."""
    cols = [c for c in df.columns if c not in (key, "batch")]
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), "batch").alias("s")).select(key, "s.*")


def latest_state(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """The newest state of every key out of the update batches."""
    return newest_state(batches(spark, folder), key)


# ------------------------------------------------------------ text accumulation


def text_pieces(messages: DataFrame) -> DataFrame:
    """Pieces of the keys' texts: key, at (order within the batch), text. ``at`` is the message's offset where it has one."""
    at = F.col("at") if "at" in messages.columns else F.monotonically_increasing_id()
    return messages.where(F.col("key").isNotNull() & F.col("value").isNotNull()).select("key", at.cast("long").alias("at"), F.col("value").alias("text"))


def concat_job(folder: str):
    """A key's text grows by a piece per message; the pieces are the state, so a key that never ends needs no large row."""
    def batch(df: DataFrame, batch_id: int) -> None:
        write_batch(text_pieces(df), folder, batch_id)

    return batch


def text_chunks(spark: SparkSession, folder: str, size: int = 1 << 16, keys: list | None = None, sep: str = "\t") -> DataFrame:
    """The text of every (asked) key so far as (key, chunk, text): pieces in the order they came, glued, cut every ``size`` characters.

    Pieces are sorted by range, so a key with very many fills several tasks; where its text goes on in the next range is told by
    one row per range and key. No task holds more than its range, no row more than ``size`` characters.
    """
    pieces = batches(spark, folder)
    pieces = pieces if keys is None else pieces.where(F.col("key").isin(keys))
    dealt = pieces.select("key", "batch", "at", "text").repartitionByRange("key", "batch", "at", F.substring("text", 1, 32))
    # written down, so that every later step sees the same ranges
    dealt = session.materialise(dealt.withColumn("range", F.spark_partition_id()), "pieces")
    n = F.char_length("text") + F.lit(len(sep))
    sums = dealt.groupBy("key", "range").agg(F.sum(n).alias("n"))
    before = F.sum("n").over(Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("key", "range", F.coalesce(before, F.lit(0)).alias("first"), before.isNull().alias("opens"))
    order = Window.partitionBy("key", "range").orderBy("batch", "at", "text")
    placed = dealt.join(offsets, ["key", "range"]).select(
        "key", (F.col("first") + F.sum(n).over(order) - n).alias("start"),
        F.when(F.col("opens") & (F.row_number().over(order) == 1), F.col("text")).otherwise(F.concat(F.lit(sep), "text")).alias("text"),
    )
    # every piece but a key's first begins with the separator, so places run one separator ahead of them
    placed = placed.withColumn("start", F.greatest(F.col("start") - len(sep), F.lit(0)))
    ends = F.col("start") + F.greatest(F.char_length("text"), F.lit(1)) - 1
    cut = placed.select("key", "start", "text", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor(ends / size))).alias("chunk"))
    low = F.greatest(F.col("start"), F.col("chunk") * size)
    cut = cut.select("key", "chunk", low.alias("low"), F.substr("text", (low - F.col("start") + 1).cast("int"), (((F.col("chunk") + 1) * size) - low).cast("int")).alias("part"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("low", "part"))), lambda p: p["part"])  # at most ``size`` characters
    return cut.groupBy("key", "chunk").agg(F.array_join(parts, "").alias("text"))


def accumulated(spark: SparkSession, folder: str, keys: list | None = None, sep: str = "\t") -> DataFrame:
    """The whole text of every (asked) key, for keys whose text fits into a row; ``text_chunks`` serves any length."""
    chunks = text_chunks(spark, folder, keys=keys, sep=sep)
    return chunks.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda c: c["text"]), "").alias("text"))


# ------------------------------------------------------------------------- CRM

# Field names of the CRM messages.
CRM_TEXT = "id name remark customerId saleProcess preSignDate loseReason winRate createTime updateTime changeTimestamp recentActivityRecordTime".split()
CRM_NESTED = {
    "customer_name": ("customer", "name"), "businessCategory_name": ("businessCategory", "name"), "master_realname": ("master", "realname"),
    "createUser_realname": ("createUser", "realname"), "updateUser_realname": ("updateUser", "realname"),
}


def crm_schema() -> T.StructType:
    s = T.StringType()
    nested: dict[str, list[str]] = {}
    for outer, inner in CRM_NESTED.values():
        nested.setdefault(outer, []).append(inner)
    item = T.StructType(
        [T.StructField(c, s) for c in CRM_TEXT]
        + [T.StructField(o, T.StructType([T.StructField(i, s) for i in sorted(set(fields))])) for o, fields in nested.items()]
        + [T.StructField("fieldMap", T.MapType(s, T.MapType(s, s)))]
    )
    return T.StructType([T.StructField("data", T.StructType([T.StructField("list", T.ArrayType(item))]))])


def crm_cells(messages: DataFrame) -> DataFrame:
    """Cells of all records of a message: fixed fields, and dynamic fields that have exactly four properties.

    ``changed``: when the record changed, as it says itself; ``at``: the message's offset where it has one.
    """
    at = (F.col("at") if "at" in messages.columns else F.lit(0)).cast("long")
    rows = messages.select(at.alias("at"), F.explode(F.from_json("value", crm_schema()).getField("data").getField("list")).alias("r"))
    base = F.map_from_arrays(
        F.array(*[F.lit(c) for c in [*CRM_TEXT[1:], *CRM_NESTED]]),
        F.array(*[F.col(f"r.{c}") for c in CRM_TEXT[1:]], *[F.col(f"r.{o}.{i}") for o, i in CRM_NESTED.values()]),
    )
    custom = F.transform_values(
        F.map_filter(F.coalesce(F.col("r.fieldMap"), F.create_map().cast("map<string,map<string,string>>")), lambda _, v: F.size(v) == 4),
        lambda _, v: F.try_element_at(v, F.lit("content")),
    )
    families = F.array(F.struct(F.lit("baseInfo").alias("family"), base.alias("cells")), F.struct(F.lit("customField").alias("family"), custom.alias("cells")))
    return (
        rows.select(F.col("r.id").alias("id"), moment(F.col("r.changeTimestamp"), F.col("r.updateTime")).alias("changed"), "at", F.explode(families).alias("f"))
        .select("id", "f.family", F.explode("f.cells").alias("label", "value"), "changed", "at")
        .where(F.col("id").isNotNull() & F.col("value").isNotNull() & (F.col("value") != "null"))
    )


def crm_job(folder: str, compact_every: int | None = None):
    """The cells of every batch; every so many batches the earlier ones become one with the newest cells."""
    def batch(df: DataFrame, batch_id: int) -> None:
        compact_before(df.sparkSession, folder, newest_cells, batch_id, compact_every)
        write_batch(crm_cells(df), folder, batch_id)

    return batch


def moment(*texts) -> Column:
    """Milliseconds of the first text that is a number of them or a date."""
    each = [F.coalesce(t.try_cast("bigint"), (t.try_cast("timestamp").cast("double") * 1000).cast("bigint")) for t in texts]
    return F.coalesce(*each)


def newest_cells(cells: DataFrame) -> DataFrame:
    """Of every cell the value changed last, by the record's own time, then batch and offset."""
    last = F.struct("changed", "batch", "at", "value")
    return cells.groupBy("id", "family", "label").agg(F.max(last).alias("s")).select("id", "family", "label", "s.*")


def crm_table(spark: SparkSession, folder: str) -> DataFrame:
    """Latest value of every cell."""
    return newest_cells(batches(spark, folder)).select("id", "family", "label", "value")


# ---------------------------------------------------------- answers on a stream


def parse(messages: DataFrame, fields: dict[str, str]) -> DataFrame:
    """JSON messages to text columns; ``fields`` maps column to JSON name."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields.values()])
    return messages.select(F.from_json("value", schema).alias("r")).select(*[F.col(f"r.{f}").alias(c) for c, f in fields.items()])


#: Fixed value: the category whose entries every question may see.
DEFAULT_CATEGORY = "默认"


def question_job(knowledge: DataFrame, folder: str, nodes: DataFrame | None = None, edges: DataFrame | None = None, default: str = DEFAULT_CATEGORY, seconds: int = 600, at=None):
    """Answers under ``robot_res_<question>`` for ten minutes. ``knowledge`` has a category; the index is built once, here."""
    seen = session.materialise(matching.by_category(knowledge, default), "knowledge")
    index = matching.knowledge_index(seen, ["category"])

    def batch(df: DataFrame, batch_id: int) -> None:
        with session.scope(df.sparkSession):
            q = parse(df, {"question_id": "questionId", "question": "question", "category": "category"})
            q = session.materialise(matching.asked_category(q, seen, default), "questions")
            found = matching.qa_with_fallback(q, seen, group=["category"], nodes=nodes, edges=edges, index=index)
            each = F.struct("level", "id", "overlap", "score", "way")
            out = found.groupBy("question_id").agg(F.to_json(F.array_sort(F.collect_list(each))).alias("data"))  # k answers at most
            out = q.select("question_id").distinct().join(out, "question_id", "left").withColumn("data", F.coalesce("data", F.lit("[]")))
            write_batch(answers(out, "robot_res_", "question_id", F.col("data"), seconds, at), folder, batch_id)

    return batch


def job_type_job(standard: DataFrame, mapping: DataFrame, folder: str, seconds: int = 600, at=None):
    """Job types under ``worktype_search_<message>`` for ten minutes."""
    def batch(df: DataFrame, batch_id: int) -> None:
        with session.scope(df.sparkSession):
            r = parse(df, {"msg_id": "msgId", "company": "insuranceCompany", "search": "searchStr"})
            out = matching.job_type_search(r, standard, mapping)
            value = F.to_json(F.struct(*[c for c in out.columns if c != "msg_id"]))
            write_batch(answers(out, "worktype_search_", "msg_id", value, seconds, at), folder, batch_id)

    return batch


def payout_job(history: DataFrame, vocab: DataFrame, rules, folder: str, default: int = 4000):
    index = matching.payout_index(history, vocab, rules)

    def batch(df: DataFrame, batch_id: int) -> None:
        with session.scope(df.sparkSession):
            c = parse(df, {"case_id": "caseId", "text": "text", "policy_no": "policyNo"})
            write_batch(matching.payout_estimate(c, history, rules, vocab, default=default, index=index), folder, batch_id)

    return batch
