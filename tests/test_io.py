"""Sinks, readers, streaming jobs, working folder and skew."""

import pytest
from pyspark.sql import functions as F

from surelake import session
from surelake.operators import headcount, profile
from surelake.sources import files, sinks
from surelake.streaming import jobs as J
from tests.conftest import SF


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_label_store_replaces_only_what_is_written(spark, tmp_path):
    path = str(tmp_path / "labels")
    schema = "entity_id string, family string, label string, value string, num double"
    sinks.write_labels(spark.createDataFrame([("a", "f", "x", "1", 1.0), ("b", "f", "x", "2", 2.0), ("a", "g", "y", "t", None)], schema), path)
    sinks.write_labels(spark.createDataFrame([("a", "f", "x", "9", 9.0)], schema), path)
    assert rows(sinks.read_labels(spark, path).select("entity_id", "label", "value")) == [("a", "x", "9"), ("a", "y", "t")]
    got = sinks.wide(sinks.read_labels(spark, path), ["x", "y"], {"x": 0}).first()
    assert (got.x, got.y) == (9.0, "t")


def test_what_was_computed_without_rows_is_emptied(spark, tmp_path):
    path = str(tmp_path / "labels")
    schema = "entity_id string, family string, label string, value string, num double"
    sinks.write_labels(spark.createDataFrame([("a", "f", "x", "1", 1.0), ("a", "f", "y z", "1", 1.0), ("a", "g", "y", "t", None)], schema), path)
    sinks.write_labels(spark.createDataFrame([("a", "f", "x", "2", 2.0)], schema), path, [("f", "x"), ("f", "y z")])
    assert rows(sinks.read_labels(spark, path).select("label", "value")) == [("x", "2"), ("y", "t")]
    days = str(tmp_path / "days")
    sinks.replace_days(spark.createDataFrame([("1", "20200101"), ("2", "20200102")], "v string, day_id string"), days)
    sinks.replace_days(spark.createDataFrame([], "v string, day_id string"), days, days=["20200102"])
    assert rows(spark.read.parquet(days).select("v")) == [("1",)]


def test_keyed_values_expire(spark, tmp_path):
    path = str(tmp_path / "keyed")
    df = spark.createDataFrame([("k", "old", "2020-01-01 00:00:00"), ("k", "new", "2020-01-01 00:05:00"), ("z", "gone", "2019-12-31 23:00:00")], "key string, v string, t string")
    sinks.write_keyed(df.where("v <> 'none'"), path, "key", "v", at=F.col("t"))
    at = F.lit("2020-01-01 00:08:00").cast("timestamp")
    assert rows(sinks.read_keyed(spark, path, at)) == [("k", "new")]


def test_text_blocks_and_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n\nthree\n\n\n")
    got = files.text_blocks(spark, str(tmp_path / "a.txt")).select("block", "record").collect()
    assert [(r.block, r.record.strip()) for r in got] == [(0, "one\ntwo"), (1, "three")]
    assert files.text_lines(spark, str(tmp_path / "*.txt")).count() == 6


@pytest.mark.parametrize("part", [97, 1000, 1 << 20])
def test_blocks_of_a_file_read_in_parts(spark, tmp_path, part):
    import random

    rnd = random.Random(part)
    want = {}
    for name in ("a", "b", "c"):
        records = [f"{name}{n} " + "word\n" * rnd.randint(0, 3) + "é漢" * rnd.randint(1, 30) for n in range(rnd.randint(1, 120))]
        (tmp_path / f"{name}.txt").write_text("\n\n".join(r + rnd.choice(["", "\n", "\n\n\n"]) for r in records) + "\n\n")
        want[name] = records
    (tmp_path / "empty.txt").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(part))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        table = files.text_blocks(spark, str(tmp_path / "*.txt"))
        got = table.collect()
        if part < 1 << 20:
            assert spark.read.text(str(tmp_path / "a.txt")).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    read = {}
    for r in sorted(got):
        read.setdefault(r.file.rsplit("/", 1)[1][0], []).append((r.block, r.record))
    assert read == {name: list(enumerate(r.strip("\n") for r in records)) for name, records in want.items()}


def test_jdbc_options():
    o = files.jdbc_options("jdbc:x", "t", user="u")
    assert files.jdbc_ranges(o, "id", 5, 900, 10) == {**o, "partitionColumn": "id", "lowerBound": "5", "upperBound": "900", "numPartitions": "10"}
    assert files.jdbc_subquery(o, "a = 1")["dbtable"] == "(SELECT * FROM t WHERE a = 1) AS t1"
    assert sinks.jdbc_write_options(o)["truncate"] == "true"


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.scratch(spark, "x").startswith(session.shared_dir(spark))


def test_filters_and_columns_reach_the_scan(inputs):
    df = inputs.lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey").count()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_one_label_reads_only_its_columns(inputs):
    from surelake.operators import claim

    text = claim.label(inputs.claims, inputs.policy, "death_num")._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in text and "l_shipdate" not in text


# ---------------------------------------------------------------- streaming


def messages(spark, path, batches):
    """One Parquet file per micro-batch."""
    for i, rows_ in enumerate(batches):
        spark.createDataFrame(rows_, "key string, value string").coalesce(1).write.mode("append").parquet(f"{path}/{i}")
    schema = spark.createDataFrame([], "key string, value string").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_routing_and_restart(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    stream = messages(spark, src, [[("open_ride", '{"a":"1"}'), ("other", '{"a":"x"}')], [("open_ride", '{"a":"2","b":"3"}')]])
    job = J.route_job({"rides": ("ride", ["a", "b"])}, out, "2020-01-01")
    J.run(stream, job, cp).awaitTermination()
    want = [("1", None), ("2", "3")]
    assert rows(spark.read.parquet(f"{out}/rides").select("a", "b").orderBy("a")) == want
    J.run(stream, job, cp).awaitTermination()  # nothing new: nothing is written twice
    assert spark.read.parquet(f"{out}/rides").count() == 2
    job(spark.createDataFrame([("open_ride", '{"a":"2","b":"3"}')], "key string, value string"), 1)  # a repeated batch replaces itself
    assert spark.read.parquet(f"{out}/rides").count() == 2


def test_crm_cells(spark):
    msg = """{"data":{"list":[{"id":"7","name":"n","remark":"null","customer":{"name":"c"},"fieldMap":{
      "F1":{"content":"v","a":"1","b":"2","c":"3"},"F2":{"content":"v","a":"1"}}},{"id":"8","name":"m","fieldMap":{}}]}}"""
    got = J.crm_cells(spark.createDataFrame([("k", msg)], "key string, value string"))
    assert rows(got.select("id", "family", "label", "value")) == [("7", "baseInfo", "customer_name", "c"), ("7", "baseInfo", "name", "n"), ("7", "customField", "F1", "v"), ("8", "baseInfo", "name", "m")]


def test_crm_latest_cell_wins(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    item = lambda n: '{"data":{"list":[{"id":"7","name":"%s","fieldMap":{}}]}}' % n
    J.run(messages(spark, src, [[("k", item("z"))], [("k", item("a"))]]), J.crm_job(out), cp).awaitTermination()
    got = J.crm_table(spark, out)
    assert got.count() == 1 and got.first()["value"] in ("a", "z")
    newest = spark.read.parquet(out).orderBy(F.col("batch").desc()).first()["value"]
    assert got.first()["value"] == newest


def test_crm_newer_record_wins_within_and_across_batches(spark, tmp_path):
    out = str(tmp_path / "crm")
    item = lambda n, t: ("k", '{"data":{"list":[{"id":"7","name":"%s","updateTime":"%s","fieldMap":{}}]}}' % (n, t))
    job = J.crm_job(out)
    schema = "key string, value string"
    job(spark.createDataFrame([item("zeta", "2020-01-01 00:00:00"), item("alpha", "2020-01-02 00:00:00")], schema), 0)
    name = lambda: J.crm_table(spark, out).where("label = 'name'").first()["value"]
    assert name() == "alpha"
    job(spark.createDataFrame([item("stale", "2019-01-01 00:00:00")], schema), 1)
    assert name() == "alpha"
    job(spark.createDataFrame([item("last", "2020-01-03 00:00:00")], schema), 2)
    assert name() == "last"
    J.compact(spark, out, J.newest_cells, upto=2)
    assert name() == "last" and spark.read.parquet(out).select("batch").distinct().count() == 1


def test_a_batch_repeated_on_another_date_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "cdc")
    batch = spark.createDataFrame([("open_ride", '{"a":"1"}')], "key string, value string")
    for day in ("2020-01-01", "2020-01-02"):
        J.route_job({"rides": ("ride", ["a"])}, out, day)(batch, 5)
    got = spark.read.parquet(f"{out}/rides").collect()
    assert len(got) == 1 and str(got[0].month) == "2020-01-02"


def test_texts_accumulate_in_order(spark, tmp_path):
    out = str(tmp_path / "texts")
    job = J.concat_job(out)
    job(spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("z", 1, "y"), ("k", 3, None)], "key string, at int, value string"), 0)
    job(spark.createDataFrame([("k", 1, "c")], "key string, at int, value string"), 1)
    job(spark.createDataFrame([("k", 1, "c")], "key string, at int, value string"), 1)
    assert rows(J.accumulated(spark, out)) == [("k", "a\tb\tc"), ("z", "y")]
    assert rows(J.accumulated(spark, out, ["z"])) == [("z", "y")]


def test_batches_leave_no_scratch_folders(spark, tmp_path):
    import os

    k = spark.createDataFrame([(1, "red car", "x", "work"), (2, "blue sky", "y", "默认")], "id int, query string, answer string, category string")
    job = J.question_job(k, str(tmp_path / "answers"), at="2020-01-01 00:00:00")
    folder = os.path.dirname(session.scratch(spark, "x"))
    counts = []
    for n in range(4):
        q = '{"questionId":"%d","question":"red sky","category":"work"}' % n
        job(spark.createDataFrame([("robot", q)], "key string, value string"), n)
        counts.append(len(os.listdir(folder)))
    assert len(set(counts)) == 1
    live = sinks.read_keyed(spark, str(tmp_path / "answers"), F.lit("2020-01-01 00:05:00").cast("timestamp"))
    assert live.count() == 4 and all(r.key.startswith("robot_res_") and '"way"' in r.value for r in live.collect())


def test_stream_state_equals_batch(spark, inputs, tmp_path):
    import datetime as dt

    base = [("110101199005101234", dt.datetime(2020, 1, d, h), dt.datetime(2020, 1, d, h), "OFO00001") for d in range(1, 20) for h in (2, 8)]
    schema = "insured_cert_no string, start_date timestamp, end_date timestamp, product_code string"
    src = str(tmp_path / "src")
    for i in range(3):
        spark.createDataFrame(base[i::3], schema).coalesce(1).write.parquet(f"{src}/{i}")
    stream = spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    out = str(tmp_path / "out")
    J.run(J.profile_state(stream), J.profile_job(out), str(tmp_path / "cp"), mode="update").awaitTermination()
    state = J.latest_state(spark, out, "insured_cert_no")
    batch = profile.ride_facts(spark.createDataFrame(base, schema))
    assert rows(profile.ride_behaviour(state, "2020-02-01")) == rows(profile.ride_behaviour(batch, "2020-02-01"))
    assert spark.read.parquet(out).select("batch").distinct().count() == 3
    # the state knows no date: later the rides are no longer recent
    assert profile.ride_behaviour(state, "2020-02-01").first().frequency != "null" and profile.ride_behaviour(state, "2020-09-01").first().frequency == "null"
    J.compact(spark, out, lambda d: J.newest_state(d, "insured_cert_no").withColumn("batch", F.lit(0)), upto=2)
    assert spark.read.parquet(out).count() == 1 and rows(J.latest_state(spark, out, "insured_cert_no").select("rides")) == [(len(base),)]


def test_review_score(spark):
    value = '{"reportHours":"1","riskDays":"2","preCompensation":"3","injury":"I005","entValueScore":"10","entRiskLevel":"2","insuredRiskLevel":"5","policyPayRate":"0.5","requestId":"r"}'
    rows_ = J.parse_reviews(spark.createDataFrame([("k", value), ("k", '{"riskDays":"x"}')], "key string, value string")).withColumn("cluster", F.lit(0))
    r = J.review_scores(rows_).collect()
    assert len(r) == 1 and (r[0].riskInfoLevel, r[0].insuredRiskLevel, r[0].score, r[0].conclusion) == (3, 2, 62.5, "审慎审核")


def test_text_pieces_lose_nothing(spark):
    df = spark.range(5000).select(F.lit("hot").alias("key"), F.col("id").cast("string").alias("value"))
    got = J.text_pieces(df).collect()
    assert sorted(x for r in got for x in r.text.split("\t")) == sorted(str(i) for i in range(5000))


# --------------------------------------------------------------------- skew


def test_hot_policy_collapses_before_ordering(spark):
    """A third of all person rows under one policy becomes at most one row per day before the ordered pass."""
    spans = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("policy_id"), (F.col("id") % 50).cast("string").alias("insured_cert_no"),
        F.lit("2020-01-01").alias("insured_start_date"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 9).cast("int")).cast("string").alias("insured_end_date"))
    policy = spark.createDataFrame([(0, "P0", "1", "2020-01-01", "2020-01-31")], "policy_id int, policy_code string, insure_code string, start_date string, end_date string")
    got = {r.day_id: r.curr_insured for r in headcount.daily_headcount(policy, spans).collect()}
    want = {f"202001{d:02d}": len({i % 50 for i in range(0, 30000, 3) if i % 9 >= d - 1}) for d in range(1, 32)}
    assert got == want
    assert headcount.disjoint_spans(spans.where("policy_id = 0")).count() <= 50 * 9


@pytest.mark.parametrize("name", ["insured_persons", "job_type_top1", "claim_rate", "daily_headcount", "product_flags_by_mobile"])
def test_no_single_partition_in_the_hot_path(spark, name):
    import __spark_entry__ as entry
    from tests.plan_audit import audit

    assert audit(entry.queries()[name](spark, SF)) == []


def test_materialised_tables_leave_no_shuffle_files(spark, tmp_path):
    import time
    from pathlib import Path

    folder = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])

    def shuffled():
        return {f.name for f in folder.parent.rglob("shuffle_*")}

    before = shuffled()
    out = session.materialise(spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count(), "counts")
    end = time.time() + 20
    while shuffled() - before and time.time() < end:  # they go behind the query's back
        time.sleep(0.2)
    assert not shuffled() - before
    assert out.agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
