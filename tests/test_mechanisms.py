"""Bitmaps, text chunks, compaction, lifetimes and replays on small cases."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from surelake import session
from surelake.operators import bitmaps as BM
from surelake.sources import sinks
from surelake.streaming import jobs as J
from surelake.streaming import keyed as K

DAY = dt.datetime(2024, 1, 1)


# ------------------------------------------------------------------ bitmaps


def _insured(spark, rows):
    return spark.createDataFrame(rows, "policy_id long, insured_id string, insured_cert_no string, insure_policy_status string")


def _bitmaps(spark, insured, policy, started, known=None):
    home = insured.join(policy, "policy_id").select(F.col("insured_cert_no").alias("person"), F.col("ent_id").alias("home"))
    numbers = BM.number_persons(home, known)
    return numbers, BM.person_bitmaps(policy, insured, started, numbers)


def test_bitmaps_count_distinct_persons(spark):
    rnd = random.Random(2)
    policy = spark.createDataFrame([(p, f"E{p % 7}" if p % 11 else "", rnd.choice(["1", "0", "4", None])) for p in range(60)], "policy_id long, ent_id string, policy_status string")
    rows = [(rnd.randrange(60), str(n), rnd.choice([None, *map(str, range(90))]), rnd.choice(["1", "2", None])) for n in range(900)]
    insured = _insured(spark, rows)
    started = spark.createDataFrame([(str(n), DAY.date() + dt.timedelta(days=n % 80)) for n in range(0, 900, 2)], "insured_id string, insured_start_date date")
    numbers, bits = _bitmaps(spark, insured, policy, started)
    all_numbers = sorted(r.number for r in numbers.collect())
    assert all_numbers == list(range(len({r[2] for r in rows if r[2]})))
    owner = {r.policy_id: r for r in policy.collect()}
    want = {}
    for p, _, cert, status in rows:
        pol = owner[p]
        if cert is None or not pol.ent_id:
            continue
        for m, ok in (("ever", pol.policy_status in ("0", "1")), ("active", pol.policy_status in ("0", "1") and status == "1"), ("now", pol.policy_status == "1" and status == "1")):
            want.setdefault((pol.ent_id, m), set()).update([cert] if ok else [])
    got = {r.ent_id: r for r in BM.distinct_persons(bits, "ent_id").collect()}
    assert {(e, m): getattr(r, m) for e, r in got.items() for m in BM.MEASURES} == {k: len(v) for k, v in want.items()}
    members = spark.createDataFrame([("E1", "c"), ("E2", "c"), ("E3", "d"), ("E3", None)], "ent_id string, channel string")
    by_channel = {r.channel: r.ever for r in BM.channel_persons(bits, members).collect()}
    assert by_channel == {"c": len(want["E1", "ever"] | want["E2", "ever"]), "d": len(want["E3", "ever"])}
    both = BM.shared_persons(bits, F.col("ent_id").isin("E1", "E2"), F.col("ent_id") == "E3").first()[0]
    assert both == len((want["E1", "ever"] | want["E2", "ever"]) & want["E3", "ever"])


def test_a_large_enterprise_fills_several_blocks_and_new_persons_follow(spark, tmp_path):
    policy = spark.createDataFrame([(1, "big", "1"), (2, "small", "1")], "policy_id long, ent_id string, policy_status string")
    def people(low, high, p):
        return spark.range(low, high).select(F.lit(p).alias("policy_id"), F.concat(F.lit(f"{p}-"), "id").alias("insured_id"), F.format_string("c%07d", "id").alias("insured_cert_no"), F.lit("1").alias("insure_policy_status"))
    first = people(0, 70_000, 1).unionByName(people(69_990, 70_010, 2))
    begun = first.select("insured_id", F.lit("2024-01-05").cast("date").alias("insured_start_date"))
    numbers, bits = _bitmaps(spark, first, policy, begun)
    numbers = session.materialise(numbers, "numbers")
    path = str(tmp_path / "bits")
    BM.write_bitmaps(bits, path)
    # the next month only adds rows: known persons keep their numbers, the stored months stay untouched
    second = people(69_000, 80_000, 1)
    later = second.select("insured_id", F.lit("2024-02-05").cast("date").alias("insured_start_date"))
    more, bits = _bitmaps(spark, second, policy, later, numbers)
    assert numbers.join(more, ["person", "number"]).count() == numbers.count() and more.agg(F.max("number")).first()[0] == 80_000 - 1
    before = session.names(spark, f"{path}/month_id=202401")
    BM.write_bitmaps(bits, path)
    assert session.names(spark, f"{path}/month_id=202401") == before
    table = spark.read.parquet(path)
    assert table.where("ent_id = 'big'").select("block").distinct().count() >= 3
    assert {r.ent_id: r.ever for r in BM.distinct_persons(table, "ent_id").collect()} == {"big": 80_000, "small": 20}
    assert table.where("ent_id = 'small'").count() == 1  # persons of one enterprise stand together


def test_small_enterprises_take_little_room(spark, tmp_path):
    policy = spark.range(3000).select(F.col("id").alias("policy_id"), F.format_string("E%04d", "id").alias("ent_id"), F.lit("1").alias("policy_status"))
    insured = spark.range(6000).select(F.floor(F.col("id") / 2).alias("policy_id"), F.col("id").cast("string").alias("insured_id"), F.format_string("c%04d", F.col("id") * 7 % 6000).alias("insured_cert_no"), F.lit("1").alias("insure_policy_status"))
    begun = insured.select("insured_id", F.lit("2024-01-05").cast("date").alias("insured_start_date"))
    _, bits = _bitmaps(spark, insured, policy, begun)
    out = str(tmp_path / "bits")
    bits.write.option("compression", "none").parquet(out)
    assert session.stored(spark, out) < 100 * 6000
    assert {(r.ever, r.active, r.now) for r in BM.distinct_persons(spark.read.parquet(out), "ent_id").collect()} == {(2, 2, 2)}


# -------------------------------------------------------------- text chunks


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_chunks_hold_the_whole_text(spark, tmp_path, size):
    rnd = random.Random(size)
    out, want = str(tmp_path / "texts"), {}
    for n in range(3):
        rows = [(rnd.choice(["hot", "hot", "hot", "a", "漢"]), k, rnd.choice([None, "", "x", "é漢" * 5, "long " * 4])) for k in rnd.sample(range(100), 40)]
        J.concat_job(out)(spark.createDataFrame(rows, "key string, at int, value string").repartition(3), n)
        for key, _, text in sorted((r for r in rows if r[2] is not None), key=lambda r: r[1]):
            want.setdefault(key, []).append(text)
    got = {}
    for r in sorted(J.text_chunks(spark, out, size).collect()):
        assert len(r.text) <= size and len(got.setdefault(r.key, [])) == r.chunk
        got[r.key].append(r.text)
    assert {k: "".join(v) for k, v in got.items()} == {k: "\t".join(v) for k, v in want.items()}
    assert all(len(c) == size for chunks in got.values() for c in chunks[:-1])
    assert {r.key: r.text for r in J.accumulated(spark, out, ["hot"]).collect()} == {"hot": "\t".join(want["hot"])}


def test_a_hot_key_is_not_gathered(spark, tmp_path):
    out = str(tmp_path / "texts")
    J.concat_job(out)(spark.range(20_000).select(F.lit("hot").alias("key"), F.col("id").alias("at"), F.lit("0123456789").alias("value")), 0)
    chunks = J.text_chunks(spark, out, 1000).select("key", "chunk", F.char_length("text").alias("n")).collect()
    assert len(chunks) == 220 and sum(r.n for r in chunks) == 20_000 * 11 - 1 and max(r.n for r in chunks) == 1000


# --------------------------------------------------------------- compaction


def _cells(spark, out):
    return sorted(map(tuple, J.crm_table(spark, out).collect()))


@pytest.mark.parametrize("fails_at", ["write", "rename", "remove"])
def test_compaction_that_stops_loses_nothing(spark, tmp_path, monkeypatch, fails_at):
    out = str(tmp_path / "cells")
    schema = "id string, family string, label string, value string, changed long, at long"
    for n in range(3):
        J.write_batch(spark.createDataFrame([("r", "f", "name", f"v{n}", n, 0), (f"only{n}", "f", "name", "x", n, 0)], schema), out, n)
    J.write_batch(spark.createDataFrame([("late", "f", "name", "y", 9, 0)], schema), out, 3)
    want = _cells(spark, out)

    def broken(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        if fails_at == "write":
            with pytest.raises(Exception):
                J.compact(spark, out, lambda d: J.newest_cells(d).withColumn("value", F.raise_error(F.lit("gone"))), 2)
        else:
            m.setattr(session, "rename" if fails_at == "rename" else "remove", broken if fails_at == "rename" else lambda s, p, old=session.remove: old(s, p) if "_building" in p else broken())
            with pytest.raises(OSError):
                J.compact(spark, out, J.newest_cells, 2)
    assert _cells(spark, out) == want
    J.compact(spark, out, J.newest_cells, 2)
    assert _cells(spark, out) == want and session.names(spark, out) == ["batch=2", "batch=3"]
    assert spark.read.parquet(out).count() == 5


def test_writers_compute_their_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    days = spark.createDataFrame([("1", "20200101"), ("2", "20200102")], "v string, day_id string")
    path = str(tmp_path / "days")
    sinks.replace_days(days, path)
    sinks.replace_days(days.where("day_id = '20200101'").mapInArrow(counted, days.schema), path, days=["20200101", "20200102"])
    assert seen.value == 1 and [r.v for r in spark.read.parquet(path).collect()] == ["1"]
    sinks.replace_days(days, path, days=["20200101", "20200102"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["1", "2"]


# ------------------------------------------------------- lifetimes, replays


def _arrive(spark, folder, n, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{n:03d}")


def test_results_run_out_after_a_restart(spark, tmp_path):
    schema = "key string, value string, written_at timestamp"
    at = lambda s: DAY + dt.timedelta(seconds=s)
    given, out, check = (str(tmp_path / d) for d in ("in", "out", "check"))

    def go():
        stream = J.file_messages(spark, f"{given}/*", "*.parquet", spark.createDataFrame([], schema).schema, 1)
        K.run_lifetimes(stream, out, check, 600).awaitTermination()
        return sorted((r.key, r.value, r.state, r.written_at) for r in spark.read.parquet(out).collect())

    _arrive(spark, given, 0, [("a", "1", at(0)), ("b", "1", at(10)), (None, "x", at(0)), ("c", None, at(0))], schema)
    _arrive(spark, given, 1, [("a", "2", at(100)), ("b", "0", at(10))], schema)
    got = go()
    assert got == [("a", "1", "live", at(0)), ("a", "2", "live", at(100)), ("b", "1", "live", at(10))]
    assert {r.key: r.value for r in K.live_results(spark, out).collect()} == {"a": "2", "b": "1"}
    # the job starts again from its checkpoint; the time of the stream passes the end of b's result, then of a's
    _arrive(spark, given, 2, [("z", "1", at(650))], schema)
    _arrive(spark, given, 3, [("z", "2", at(651))], schema)
    assert ("b", "1", "expired", at(10)) in go()
    assert {r.key for r in K.live_results(spark, out).collect()} == {"a", "z"}
    _arrive(spark, given, 4, [("z", "3", at(800))], schema)
    _arrive(spark, given, 5, [("b", "9", at(900))], schema)
    got = go()
    assert ("a", "2", "expired", at(100)) in got and ("a", "1", "expired", at(0)) not in got
    assert {r.key: r.value for r in K.live_results(spark, out).collect()} == {"b": "9", "z": "3"}


def test_replays_and_late_messages(spark, tmp_path):
    schema = "id long, event_time timestamp, body string"
    given, out, late = (str(tmp_path / d) for d in ("in", "out", "late"))
    rows = [[(100 * f + k, DAY + dt.timedelta(minutes=60 * f + k), f"{f}-{k}") for k in range(30)] for f in range(4)]
    rnd = random.Random(3)
    order = [rows[0], rows[1], rows[0], rows[2], rows[1], rows[3], rows[0] + [(7777, DAY, "too late"), (None, DAY, "no id")], rows[3]]
    for n, part in enumerate(order):
        _arrive(spark, given, n, rnd.sample(part, len(part)), schema)
    stream = J.file_messages(spark, f"{given}/*", "*.parquet", spark.createDataFrame([], schema).schema, 1)
    K.run_once(stream, out, str(tmp_path / "check"), "30 minutes").awaitTermination()
    got = sorted((r.id, r.body) for r in spark.read.parquet(out).collect())
    assert got == sorted((i, b) for part in rows for i, _, b in part)
    assert K.write_late(spark.read.parquet(f"{given}/*"), out, late) == 1
    assert [(r.id, r.body) for r in spark.read.parquet(late).collect()] == [(7777, "too late")]
    assert K.write_late(spark.read.parquet(f"{given}/*"), out, late) == 1


# ------------------------------------------------------ headcounts kept up


@pytest.mark.parametrize("digits", [8, 6])
def test_ten_days_equal_one_run(spark, tmp_path, digits):
    from surelake.operators import headcount as H
    from surelake.operators import headcount_store as HS

    rnd = random.Random(5)
    path, buckets = str(tmp_path / "store"), 8
    p_schema = "policy_id long, policy_code string, start_date date, end_date date"
    s_schema = "policy_id long, insured_id string, insured_cert_no string, insured_start_date date, insured_end_date date"
    on = lambda n: DAY.date() + dt.timedelta(days=n)
    policies, persons = {}, {}
    for _ in range(10 if digits == 8 else 4):
        new_p = {p: (p, rnd.choice([f"C{p}", f"C{p}", None]), on(rnd.randrange(20)), on(rnd.randrange(10, 40))) for p in rnd.sample(range(30), 3)}
        new_s = {}
        for _ in range(6):
            p, i = rnd.randrange(30), rnd.randrange(6)
            first = rnd.randrange(-3, 30)
            new_s[p, str(i)] = (p, str(i), rnd.choice(["a", "b", "c", None]), rnd.choice([on(first), on(first), None]), on(first + rnd.randrange(-1, 15)))
        before = {f: session.names(spark, f"{path}/{f}") for f in ("policies", "spans", "steps", "daily")}
        files = {f"{f}/{n}": session.names(spark, f"{path}/{f}/{n}") for f, names in before.items() for n in names}
        told = HS.apply_changes(spark, path, spark.createDataFrame(list(new_p.values()), p_schema), spark.createDataFrame(list(new_s.values()), s_schema), buckets, digits)
        policies |= new_p
        persons |= new_s
        hit = {r.bucket for r in spark.createDataFrame([(p,) for p in {*new_p, *(k[0] for k in new_s)}], "policy_id long").select(HS.bucket_of(buckets)).collect()}
        assert set(told["buckets"]) == hit
        for name, old in files.items():  # folders of other buckets and days are as they were
            part = name.split("=")[1]
            if part not in {*map(str, told["buckets"]), *told["days"]}:
                assert session.names(spark, f"{path}/{name}") == old
        full = H.daily_headcount(
            spark.createDataFrame([p for p in policies.values() if p[1]], p_schema), spark.createDataFrame([s for s in persons.values() if s[3]], s_schema)
        )
        want = sorted((r.policy_id, r.policy_code, r.day_id, r.curr_insured) for r in full.collect())
        assert sorted(map(tuple, HS.daily_headcount(spark, path).collect())) == want
    again = HS.apply_changes(spark, path, spark.createDataFrame(list(new_p.values()), p_schema), spark.createDataFrame(list(new_s.values()), s_schema), buckets, digits)
    some = ["20240110", "20240205"]
    assert sorted(map(tuple, HS.daily_headcount(spark, path, some).collect())) == [w for w in want if w[2] in some]
    assert again["days"] == [] and sorted(map(tuple, HS.daily_headcount(spark, path).collect())) == want


def test_the_kept_daily_table_holds_runs_of_days(spark, tmp_path):
    from surelake.operators import headcount_store as HS

    path, on = str(tmp_path / "store"), lambda n: DAY.date() + dt.timedelta(days=n)
    policy = spark.createDataFrame([(1, "C1", on(0), on(59))], "policy_id long, policy_code string, start_date date, end_date date")
    # b follows a on the next day, so the headcount stays
    spans = spark.createDataFrame([(1, "1", "a", on(10), on(19)), (1, "2", "b", on(20), on(29))], "policy_id long, insured_id string, insured_cert_no string, insured_start_date date, insured_end_date date")
    HS.apply_changes(spark, path, policy, spans, 2, 6)
    stored = spark.read.parquet(f"{path}/daily")
    assert sorted((r["first"], r["last"], r.n) for r in stored.collect()) == [(on(0), on(9), 0), (on(10), on(29), 1), (on(30), on(30), 0), (on(31), on(59), 0)]
    days = HS.daily_headcount(spark, path).collect()
    assert len(days) == 60 and sum(r.curr_insured for r in days) == 20


def test_partitions_follow_the_size_of_the_input(spark, tmp_path, monkeypatch):
    spark.range(20_000).selectExpr("cast(uuid() as string) AS u").coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    size = session.stored(spark, str(tmp_path))
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", size // 40)
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        session.tune(spark, str(tmp_path))
        assert 40 <= int(spark.conf.get(name)) <= 42
    finally:
        spark.conf.unset(name)


def test_a_task_reads_a_bounded_part_of_the_files(spark, tmp_path, monkeypatch):
    spark.range(40_000).selectExpr("cast(uuid() as string) AS u").repartition(20).write.parquet(str(tmp_path / "t.parquet"))
    size = session.stored(spark, str(tmp_path))
    most, cost, parts = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(session, "READ_PER_TASK", size // 10)
    tasks = lambda: spark.read.parquet(str(tmp_path / "t.parquet")).rdd.getNumPartitions()
    try:
        spark.conf.set(cost, "1")
        before = tasks()
        session.tune(spark, str(tmp_path))
        assert before < 10 <= tasks()
        spark.conf.set(most, str(size // 30))
        session.tune(spark, str(tmp_path))
        assert spark.conf.get(most) == str(size // 30)  # a smaller limit of the session stays
    finally:
        for name in (most, cost, parts):
            spark.conf.unset(name)


#: findings on the memory of a task: each of these queries has the number of its shuffles from the size of its input
GROWN = (
    "model_risk_tree",
    "model_score",
    "risk_features",
    "premium_slope",
    "premium_policy_to_date",
    "daily_headcount",
    "headcount_ent_day",
    "headcount_month_peak",
    "premium_by_plans",
)


@pytest.mark.parametrize("name", GROWN)
def test_every_shuffle_of_a_query_follows_the_size_of_the_input(spark, monkeypatch, name):
    import __spark_entry__ as entry

    plans, write = [], session.materialise
    size = sum(os.path.getsize(f"{entry.SMOKE_DIR}/{f}") for f in os.listdir(entry.SMOKE_DIR))
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", size // 40, raising=False)
    monkeypatch.setattr(session, "materialise", lambda df, n: plans.append(df) or write(df, n))
    part = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        plans.append(entry.queries()[name](spark, entry.SMOKE_DIR))
        text = "\n".join(p._jdf.queryExecution().executedPlan().toString() for p in plans)
    finally:
        spark.conf.unset(part)
    dealt = [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*, (\d+)\),", text)]
    assert dealt and min(dealt) >= 40


def test_a_table_of_several_files_streams_like_one_file(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [(c, t, "user" if t % 2 else "assistant", None if (c, t) == (2, 3) else f"text {c} {t}") for c in range(1, 5) for t in range(1, 6)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    table.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.key: r.text for r in entry.queries()["stream_state_concat"](spark, str(tmp_path)).collect()}
    assert got == {str(c): "\t".join(x for d, _, _, x in rows if d == c and x) for c in range(1, 5)}
    chunks = {r.key: r.text for r in entry.queries()["stream_text_chunks"](spark, str(tmp_path)).collect()}
    assert chunks == {k: "\t".join(x for _, _, role, x in rows if role == k and x) for k in ("user", "assistant")}


# ------------------------------------------------------------------- names


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_names_equal_brute_force(spark, seed):
    from collections import Counter
    from math import sqrt

    from surelake.operators import matching as MT

    rnd = random.Random(seed)
    kind = ["abc", "abcdefghij kl", "劳务公司有限科技北京上海ab"][seed - 1]
    made = lambda: "".join(rnd.choice(kind) for _ in range(rnd.randint(0, 14)))
    holders = [None, "", "zzz", *(made() for _ in range(150))]
    buyers = [None, "", "?!", "z", *(made() for _ in range(60)), *(h[::-1] for h in holders[3:20]), *(h + "a" for h in holders[3:20])]
    h, b = (spark.createDataFrame([(n,) for n in d], "name string") for d in (holders, buyers))
    got = {r.name: r for r in MT.search_names(b, h).collect()}
    bags = {n: Counter(n) for n in {*holders, *buyers} - {None, ""}}
    norm = {n: sqrt(sum(v * v for v in c.values())) for n, c in bags.items()}
    for name in {*buyers} - {None, ""}:
        best = None
        for other in {*holders} - {None, ""}:
            dot = sum(v * bags[other][c] for c, v in bags[name].items())
            if dot:
                s = round(min(dot / (norm[name] * norm[other]), 1.0) + 1e-12, 4)
                best = min(best or (0, ""), (-s, other)) if best else (-s, other)
        assert (name in got) == (best is not None)
        if best:
            assert (-got[name].similarity, got[name].holder) == best and 1 <= got[name].compared <= len(set(holders))


# ------------------------------------------------- models as expressions


@pytest.mark.parametrize("seed", [1, 2])
def test_expressions_predict_as_the_stored_models(spark, tmp_path, seed):
    from surelake.operators import model_columns as MC
    from surelake.operators import models as M

    rnd = random.Random(seed)
    rows = [(rnd.gauss(0, 3), float(rnd.randrange(9)), rnd.random() * 1e5, 4.0, float(rnd.randrange(4))) for _ in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, `c.d` double, same double, label double").withColumnRenamed("c.d", "c")
    cols = ["a", "b", "c", "same"]
    models = [M.train_tree(df, cols, "label", depth=5), M.train_tree(df, cols, "label", scale=False, impurity="gini")]
    models += [M.train_kmeans(df, cols, k=5, scaler=s) for s in ("minmax", "standard")]
    for n, model in enumerate(models):
        path = str(tmp_path / f"m{n}")
        M.save(model, path)
        stored = M.load(path)
        both = stored.transform(df).withColumn("mine", MC.prediction(stored).cast("double"))
        assert both.where(F.col("mine") != F.col("prediction")).isEmpty() and both.where("mine IS NULL").isEmpty()
        assert df.limit(1).withColumn("b", F.lit(None).cast("double")).select(MC.prediction(stored).alias("p")).first().p is None
        plan = df.select(MC.prediction(stored).alias("p"))._jdf.queryExecution().executedPlan().toString()
        assert "UDF" not in plan and "Python" not in plan
    report = {r.cluster: (r.members, r.cost) for r in M.cluster_report(models[2], df, cols).collect()}
    assert sum(m for m, _ in report.values()) == 400
    assert abs(sum(c for _, c in report.values()) - models[2].stages[-1].summary.trainingCost) < 1e-6


def _plain_tree(rows, feats, cuts, bins, depth):
    """The same trees grown row by row: {node: (prediction, feature, cut)}."""
    from math import log2

    from surelake.operators.tree_sweep import allowed

    def entropy(labels):
        return -sum(labels.count(k) / len(labels) * log2(labels.count(k) / len(labels)) for k in set(labels))

    def cell(r, f):
        return sum(r[f] > x for x in cuts[f])

    out = {}

    def go(own, node, left):
        labels = [r[-1] for r in own]
        best = None
        for f in range(feats):
            for j in allowed(len(cuts[f]), bins):
                a, b = [r[-1] for r in own if cell(r, f) <= j], [r[-1] for r in own if cell(r, f) > j]
                if a and b:
                    gain = entropy(labels) - len(a) / len(own) * entropy(a) - len(b) / len(own) * entropy(b)
                    if gain > 1e-12 and (best is None or round(gain, 12) > best[0]):
                        best = round(gain, 12), f, j
        split = best[1:] if best and left else (None, None)
        out[node] = (min(set(labels), key=lambda k: (-labels.count(k), k)), *split)
        if split[0] is not None:
            f, j = split
            go([r for r in own if cell(r, f) <= j], 2 * node, left - 1)
            go([r for r in own if cell(r, f) > j], 2 * node + 1, left - 1)

    go(rows, 1, depth)
    return out


def test_trees_from_shared_counts_equal_trees_grown_alone(spark):
    from math import log1p, sqrt

    from surelake.operators import tree_sweep as TS

    rnd = random.Random(12)
    rows = [(rnd.gauss(0, 1), float(rnd.randrange(6)), rnd.random()) for _ in range(160)]
    rows = [(*r, (int(r[0] > 0.3) + 2 * int(r[1] > 2) if rnd.random() < 0.85 else rnd.randrange(4))) for r in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int")
    cuts = TS.fine_cuts(df, ["a", "b", "c"], 16)
    got = TS.grow(TS._cells(df, ["a", "b", "c"], cuts, "label", [2, 5, 16]), cuts, 4, [2, 5, 16], 4)
    for bins in (2, 5, 16):
        alone = {n: v for n, v in _plain_tree(rows, 3, cuts, bins, 4).items()}
        mine = {n: (p, f, c) for b, n, p, f, c in got if b == bins}
        # equal cuts may stand for several allowed numbers: compare what they part
        side = lambda f, c: None if f is None else (f, frozenset(n for n, r in enumerate(rows) if sum(r[f] > x for x in cuts[f]) <= c))
        assert {n: v[0] for n, v in mine.items()} == {n: v[0] for n, v in alone.items()}
        assert mine.keys() == alone.keys() and all((mine[n][1] is None) == (alone[n][1] is None) for n in mine)
        assert all(mine[n][1] == alone[n][1] for n in mine) and side(*mine[1][1:]) == side(*alone[1][1:])
    test = rows[:50]
    errors = {(r.parameter, r.value): r.rmsle for r in TS.sweep(df, spark.createDataFrame(test, df.schema), ["a", "b", "c"], "label", 4, depths=(0, 1, 3), bins=(2, 5), depth_bins=16, bins_depth=2).collect()}

    def error(tree, depth):
        total = 0.0
        for r in test:
            node = 1
            while tree[node][1] is not None and node.bit_length() <= depth:
                node = 2 * node + (sum(r[tree[node][1]] > x for x in cuts[tree[node][1]]) > tree[node][2])
            total += (log1p(tree[node][0]) - log1p(r[-1])) ** 2
        return sqrt(total / len(test))

    for (parameter, value), got_error in errors.items():
        bins, depth = (16, value) if parameter == "depth" else (value, 2)
        assert abs(got_error - error(_plain_tree(rows, 3, cuts, bins, 3), depth)) < 1e-9


# ------------------------------------------------------- layouts of tables


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    import uuid

    from surelake.sources import lake

    policy = spark.range(50).select(F.col("id").alias("policy_id"))
    insured = spark.range(600).select((F.col("id") % 40).alias("policy_id"), F.when(F.col("id") % 7 > 0, F.col("id") % 13).cast("string").alias("insured_cert_no"))
    claims = spark.range(90).select((F.col("id") % 30).alias("policy_id"))
    want = sorted(map(tuple, lake.policy_counts(policy, insured, claims).collect()))
    tables = [lake.write_bucketed(d, str(tmp_path / n), f"{n}_{uuid.uuid4().hex}", "policy_id", 4) for n, d in (("p", policy), ("i", insured), ("c", claims))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lake.policy_counts(*tables)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan and "SortMergeJoin" in plan
        assert sorted(map(tuple, got.collect())) == want and len(want) == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buckets_follow_the_size_of_the_input(spark, inputs, monkeypatch):
    from surelake.plans import q_lake

    want = sorted(map(tuple, q_lake._bucketed(inputs).collect()))
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", 1 << 15)
    buckets = session.shares(spark, inputs.folder)
    assert buckets > 8
    got = q_lake._bucketed(inputs)
    assert f"SelectedBucketsCount: {buckets} out of {buckets}" in got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert sorted(map(tuple, got.collect())) == want


def test_only_the_newest_day_is_read(spark, tmp_path):
    from surelake.sources import lake

    path = tmp_path / "days"
    facts = spark.createDataFrame([(n, f"2024010{n % 5 + 1}") for n in range(50)], "v long, day_id string")
    lake.write_days(facts, str(path))
    calendar = spark.createDataFrame([(f"2024010{d}",) for d in range(1, 6)], "day_id string")
    for file in path.glob("day_id=*/*.parquet"):  # what is not to be read cannot be read any more
        if "20240103" not in str(file):
            file.write_bytes(b"no parquet")
    for file in path.glob("day_id=*/.*.crc"):
        file.unlink()
    got = lake.on_newest_day(lake.read_days(spark, str(path), facts.schema), calendar, "20240103")
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in got.collect()) == list(range(2, 50, 5))
    with pytest.raises(Exception):
        lake.on_newest_day(lake.read_days(spark, str(path), facts.schema), calendar, "20240105").collect()


# --------------------------------------------------------------- keywords


def test_keywords_found_as_by_plain_search(spark, monkeypatch):
    from surelake.operators import automaton as AM
    from surelake.operators import overlap

    rnd = random.Random(4)
    monkeypatch.setattr(AM, "PIECE", 7)
    made = lambda letters, low, high: "".join(rnd.choice(letters) for _ in range(rnd.randint(low, high)))
    needles = [None, "", "a", "aa", "aaaa", "é漢", "🙂", "b\n", *(made("ab漢", 1, 6) for _ in range(40)), *(made("abc🙂 ", 2, 12) for _ in range(30))]
    texts = [None, "", "a", "aaaaaaaaaaaaaaaaaaaaaaaa", "x🙂é漢b\n", *(made("ab漢", 0, 60) for _ in range(60)), *(made("abc🙂 z", 0, 200) for _ in range(60))]
    q = spark.createDataFrame([(n, s, n % 2) for n, s in enumerate(needles)], "qid int, needle string, side int")
    t = spark.createDataFrame([(n, s, n % 2) for n, s in enumerate(texts)], "kid long, text string, side int").repartition(3)
    want = {(i, j) for i, s in enumerate(needles) if s for j, x in enumerate(texts) if x and s in x}
    got = AM.containing_once(q, t).collect()
    assert len(got) == len(want) and set(map(tuple, got)) == want
    assert set(map(tuple, AM.containing_once(q, t, most_letters=10).collect())) == want
    sided = AM.containing_once(q, t, ["side"])
    assert set(map(tuple, sided.collect())) == {(i, j) for i, j in want if i % 2 == j % 2} == set(map(tuple, overlap.containing(q.where("needle <> ''"), t, ["side"]).collect()))
    assert AM.containing_once(q.limit(0), t).count() == 0 and AM.containing_once(q, t.limit(0)).count() == 0


@pytest.mark.parametrize("every", [None, 1, 3])
def test_jobs_compact_what_they_wrote(spark, tmp_path, every):
    cells, state = str(tmp_path / "cells"), str(tmp_path / "state")
    item = '{"data":{"list":[{"id":"%s","name":"%s","changeTimestamp":"%d"}]}}'
    crm, profile = J.crm_job(cells, every), J.profile_job(state, every)
    for n in range(8):
        rows = [("k", item % ("r", f"v{n}", n)), ("k", item % (f"own{n}", "x", n))]
        crm(spark.createDataFrame(rows, "key string, value string"), n)
        profile(spark.createDataFrame([("a", n), (f"p{n}", n)], "insured_cert_no string, rides int"), n)
    names = {(r.id, r.value) for r in J.crm_table(spark, cells).where("label = 'name'").collect()}
    assert names == {("r", "v7"), *((f"own{n}", "x") for n in range(8))}
    assert {(r.insured_cert_no, r.rides) for r in J.latest_state(spark, state, "insured_cert_no").collect()} == {("a", 7), *((f"p{n}", n) for n in range(8))}
    assert len(session.names(spark, cells)) == len(session.names(spark, state)) == {None: 8, 1: 2, 3: 3}[every]
