"""Streaming queries: the tables are read as file streams, turned into messages and run to the end."""

from pyspark.sql import functions as F

from .. import session
from ..functions import scalars as S
from ..operators import matching as MT
from ..operators import models as M
from ..operators import profile as PF
from ..sources import sinks
from ..streaming import jobs as J
from .catalog import query
from .q_text import BRANCHES, PAYOUT_SQL, TOK, _history
from .views import EVENT_AS_OF


def _stream(v, table):
    """A table as a stream of the files it consists of: one of its name, or those in a folder of its name."""
    path, schema = f"{v.folder}/{table}.parquet", getattr(v, table).schema
    if session.is_folder(v.spark, path):
        return J.file_messages(v.spark, path, "*", schema)
    return J.file_messages(v.spark, v.folder, f"{table}.parquet", schema)


def _run(v, stream, batch, mode="append"):
    J.run(stream, batch, session.scratch(v.spark, "checkpoint"), mode=mode).awaitTermination()


def _events(v):
    e = _stream(v, "events")
    props = F.from_json("props", "map<string,string>")
    return e.withColumn("k", F.try_element_at(props, F.lit("k")))


# ---------------------------------------------------------- change routing

ROUTES = {
    "rides": ("ride", ["policy_id", "user_id", "start_date", "status"]),
    "orders": ("order", ["policy_id", "user_id", "premium"]),
    "errors": ("error", ["policy_id", "status"]),
    "views": ("view", ["policy_id", "user_id"]),
}
_KEY = "CASE event_type WHEN 'click' THEN 'open_ride_policy' WHEN 'purchase' THEN 'open_order_policy' WHEN 'signup' THEN 'other' ELSE concat('open_', event_type) END"


def _changes(v):
    body = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("policy_id"), F.col("user_id").cast("string").alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("start_date"), F.col("value").cast("string").alias("premium"), F.col("k").alias("status")))
    return _events(v).select(F.expr(_KEY).alias("key"), body.alias("value"))


def _cdc(v):
    folder = session.scratch(v.spark, "cdc")
    _run(v, _changes(v), J.route_job(ROUTES, folder, EVENT_AS_OF))
    parts = [
        v.spark.read.parquet(f"{folder}/{name}").select(F.lit(name).alias("target"), F.col("month").cast("string").alias("month"), "policy_id")
        for name in ROUTES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


query("stream_cdc_route", f"""
SELECT CASE event_type WHEN 'click' THEN 'rides' WHEN 'purchase' THEN 'orders' WHEN 'error' THEN 'errors' ELSE 'views' END AS target,
  '{EVENT_AS_OF}' AS month, cast(event_id AS varchar) AS policy_id FROM events WHERE event_type <> 'signup'""")(_cdc)

# -------------------------------------------------------------- review score

_REVIEW = """CASE event_type WHEN 'error' THEN 'I005' ELSE 'I001' END"""


def _review_frame(e):
    d = F.to_date("ts")
    return e.select(
        (F.hour("ts") + 1).cast("double").alias("reportHours"), F.dayofmonth(d).cast("double").alias("riskDays"), F.col("value").alias("preCompensation"),
        F.expr(_REVIEW).alias("injury"), (F.col("user_id") % 60).cast("string").alias("entValueScore"), (F.col("user_id") % 4).cast("string").alias("entRiskLevel"),
        (F.col("user_id") % 7).cast("string").alias("insuredRiskLevel"), F.round(F.col("value") / 100, 4).cast("string").alias("policyPayRate"),
        F.col("event_id").cast("string").alias("requestId"))


def _reviews(v):
    frame = _review_frame(v.events)
    model = M.train_kmeans(frame, J.REVIEW_FEATURES, k=3, scaler="standard")
    folder = session.scratch(v.spark, "reviews")
    msgs = _review_frame(_events(v)).select(F.col("requestId").alias("key"), F.to_json(F.struct("*")).alias("value"))
    _run(v, msgs, J.review_job(model, folder, at="2024-01-31 00:00:00"))
    return sinks.read_keyed(v.spark, folder, F.lit("2024-01-31 00:05:00").cast("timestamp"))


# The cluster of the stored model is trained, so all that does not hang on it is compared: severe injuries whole,
# and for every message whether the stored score follows from the stored levels.
_REVIEW_OUT = "requestId string, policyPayRate double, entRiskLevel string, insuredRiskLevel int, riskInfoLevel int, score double, conclusion string"


def _review_checked(v):
    r = _reviews(v).select("key", F.from_json("value", _REVIEW_OUT).alias("r")).select("key", "r.*")
    severe = v.events.where("event_type = 'error'").select(F.col("event_id").cast("string").alias("requestId"), F.lit(True).alias("severe"))
    r = r.join(severe, "requestId", "left")
    level = lambda c: F.when(c == 1, 0).when(c == 2, 50).otherwise(100)
    again = level(F.col("riskInfoLevel")) * 0.25 + level(F.col("insuredRiskLevel")) * 0.25 + level(F.col("entRiskLevel").try_cast("int")) * 0.30 + F.col("policyPayRate") * 100 * 0.20
    return r.select(
        "key", "insuredRiskLevel", F.when(F.col("severe"), F.col("riskInfoLevel")).alias("info"), F.when(F.col("severe"), F.round("score", 6)).alias("score"),
        F.when(F.col("severe"), F.col("conclusion")).alias("conclusion"), (F.abs(again - F.col("score")) < 1e-9).alias("follows"))


_LV = "CASE {} WHEN 1 THEN 0 WHEN 2 THEN 50 ELSE 100 END"
query("review_score", f"""
WITH r AS (SELECT cast(event_id AS varchar) AS "requestId", CASE WHEN user_id % 7 IN (1, 2) THEN 1 WHEN user_id % 7 IN (5, 6) THEN 2 ELSE 3 END AS p,
  CASE WHEN event_type = 'error' THEN 3 ELSE user_id % 3 + 1 END AS i, user_id % 4 AS e, cast(user_id % 60 AS double) AS val, round(value / 100, 4) AS rate FROM events),
s AS (SELECT *, {_LV.format('i')} * 0.25::DOUBLE + {_LV.format('p')} * 0.25::DOUBLE + {_LV.format('e')} * 0.30::DOUBLE + rate * 100 * 0.20::DOUBLE AS sc FROM r)
SELECT "requestId", p AS "insuredRiskLevel", cast(i AS bigint) AS "riskInfoLevel", round(sc, 6) AS score,
  CASE WHEN b > 0 AND b <= 25 THEN '从宽审核' WHEN b > 25 AND b <= 50 THEN '正常审核' WHEN b > 50 AND b <= 75 THEN '审慎审核' WHEN b > 75 AND b <= 100 THEN '严格审核' END AS conclusion
FROM (SELECT *, sc - val * 0.10::DOUBLE AS b FROM s)""")(
    lambda v: J.review_scores(
        J.parse_reviews(_review_frame(v.events).select(F.to_json(F.struct("*")).alias("value"))).join(
            v.events.select(F.col("event_id").cast("string").alias("requestId"), (F.col("user_id") % 3).alias("cluster")), "requestId")
    ).select("requestId", "insuredRiskLevel", F.col("riskInfoLevel").cast("bigint").alias("riskInfoLevel"), F.round("score", 6).alias("score"), "conclusion")
)

query("stream_review_score", f"""
WITH r AS (SELECT event_id, event_type = 'error' AS sev, CASE WHEN user_id % 7 IN (1, 2) THEN 1 WHEN user_id % 7 IN (5, 6) THEN 2 ELSE 3 END AS p,
  user_id % 4 AS e, cast(user_id % 60 AS double) AS val, round(value / 100, 4) AS rate FROM events),
s AS (SELECT *, 100 * 0.25::DOUBLE + {_LV.format('p')} * 0.25::DOUBLE + {_LV.format('e')} * 0.30::DOUBLE + rate * 100 * 0.20::DOUBLE AS sc FROM r),
t AS (SELECT *, sc - val * 0.10::DOUBLE AS b FROM s)
SELECT concat('enter_model_res_', event_id) AS key, p AS "insuredRiskLevel", CASE WHEN sev THEN 3 END AS info, CASE WHEN sev THEN round(sc, 6) END AS score,
  CASE WHEN NOT sev THEN NULL WHEN b > 0 AND b <= 25 THEN '从宽审核' WHEN b > 25 AND b <= 50 THEN '正常审核' WHEN b > 50 AND b <= 75 THEN '审慎审核'
    WHEN b > 75 AND b <= 100 THEN '严格审核' END AS conclusion, true AS follows FROM t""")(_review_checked)

# ------------------------------------------------------------ keyed state


def _ride_stream(v):
    rides = v.rides.schema
    e = _stream(v, "events")
    card = F.concat(
        (10 + F.col("user_id") % 25).cast("string"), F.lit("0101"),
        F.date_format(F.date_add(F.lit("1960-01-01").cast("date"), ((F.col("user_id") * 37) % 14600).cast("int")), "yyyyMMdd"),
        F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0"), (F.col("user_id") % 10).cast("string"))
    return e.select(
        card.alias("insured_cert_no"), F.col("ts").alias("start_date"), (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("end_date"),
        F.when(F.col("event_type") == "click", "OFO00001").when(F.col("event_type") == "view", "OFO00002").otherwise("").alias("product_code"),
    )


def _profile(v):
    folder = session.scratch(v.spark, "profiles")
    _run(v, J.profile_state(_ride_stream(v)), J.profile_job(folder), mode="update")
    facts = J.latest_state(v.spark, folder, "insured_cert_no")
    return PF.ride_behaviour(facts, EVENT_AS_OF).select("insured_cert_no", "early_night", "work", "weeks", "frequency", "user_insure_product_num")


query("stream_profile_state", """
WITH r AS (SELECT *, hour(start_date) >= 22 OR hour(start_date) <= 3 AS owl, hour(start_date) BETWEEN 4 AND 7 AS early, isodow(start_date) AS wd,
  isodow(start_date) <= 5 AND hour(start_date) BETWEEN 6 AND 9 AS com FROM rides),
w AS (SELECT insured_cert_no, wd, row_number() OVER (PARTITION BY insured_cert_no ORDER BY count(*) DESC, wd) AS k FROM r GROUP BY 1, 2),
g AS (SELECT insured_cert_no, count(*) AS n, count(*) FILTER (owl) AS o, count(*) FILTER (early) AS e, count(*) FILTER (com) AS c FROM r GROUP BY 1)
SELECT insured_cert_no, CASE WHEN o > e AND o >= 10 THEN '夜猫子' WHEN e > o AND e >= 10 THEN '早起族' ELSE 'null' END AS early_night,
  CASE WHEN c >= 3 THEN '上班族' ELSE 'null' END AS work, cast(wd AS varchar) AS weeks, cast(90 // n AS varchar) AS frequency, n AS user_insure_product_num
FROM g JOIN w USING (insured_cert_no) WHERE k = 1""")(_profile)


def _texts(v, key):
    folder = session.scratch(v.spark, "texts")
    at = (F.col("conv_id") * 1000 + F.col("turn")) if key == "role" else F.col("turn")
    msgs = _stream(v, "conversations").select(F.col(key).cast("string").alias("key"), at.alias("at"), F.col("text").alias("value"))
    _run(v, msgs, J.concat_job(folder))
    return folder


query("stream_state_concat", "SELECT cast(conv_id AS varchar) AS key, string_agg(text, chr(9) ORDER BY turn, text) AS text FROM conversations WHERE text IS NOT NULL AND conv_id IS NOT NULL GROUP BY 1")(
    lambda v: J.accumulated(v.spark, _texts(v, "conv_id"))
)
# few keys, each with a large share of all messages, read as chunks
CHUNK = 5000
query("stream_text_chunks", f"""
WITH t AS (SELECT role AS key, string_agg(text, chr(9) ORDER BY conv_id * 1000 + turn, text) AS text FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL GROUP BY 1),
c AS (SELECT key, text, unnest(generate_series(0, (greatest(length(text), 1) - 1) // {CHUNK})) AS chunk FROM t)
SELECT key, chunk, substr(text, chunk * {CHUNK} + 1, {CHUNK}) AS text FROM c""")(lambda v: J.text_chunks(v.spark, _texts(v, "role"), CHUNK))

# --------------------------------------------------------------------- CRM


def _crm_messages(v):
    e = _events(v)
    prop = F.create_map(F.lit("content"), F.col("value").cast("string"), F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"), F.lit("c"), F.lit("3"))
    short = F.create_map(F.lit("content"), F.lit("dropped"), F.lit("a"), F.lit("1"))
    fields = F.map_from_arrays(F.array(F.lit("CustomField_1"), F.lit("CustomField_2")), F.array(prop, short))
    record = [
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("name"), F.when(F.col("user_id") % 2 == 0, "null").otherwise("note").alias("remark"),
        F.struct(F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name")).alias("customer"), F.struct(F.lit("boss").alias("realname")).alias("master")]
    number = F.col("event_id") * 1000
    item = F.struct(*record, (number + 1).cast("string").alias("changeTimestamp"), fields.alias("fieldMap"))
    # an older state of the same record, whose name is the larger text, comes after the newer one in the same message
    old = F.struct(record[0], F.lit("zz old").alias("name"), *record[2:], number.cast("string").alias("changeTimestamp"), F.lit(None).cast("map<string,map<string,string>>").alias("fieldMap"))
    return e.select(F.lit("crm").alias("key"), F.to_json(F.struct(F.struct(F.array(item, old).alias("list")).alias("data"))).alias("value"))


def _crm(v):
    folder = session.scratch(v.spark, "crm")
    _run(v, _crm_messages(v), J.crm_job(folder))
    J.compact(v.spark, folder, J.newest_cells, upto=0)
    rounded = F.round(F.col("value").try_cast("double"), 2).cast("string")
    return J.crm_table(v.spark, folder).withColumn("value", F.when(F.col("label") == "CustomField_1", rounded).otherwise(F.col("value")))


query("stream_crm_upsert", """
SELECT cast(event_id AS varchar) AS id, 'baseInfo' AS family, 'name' AS label, event_type AS value FROM events
UNION ALL SELECT cast(event_id AS varchar), 'baseInfo', 'remark', 'note' FROM events WHERE user_id % 2 = 1
UNION ALL SELECT cast(event_id AS varchar), 'baseInfo', 'customer_name', concat('user ', user_id) FROM events
UNION ALL SELECT cast(event_id AS varchar), 'baseInfo', 'master_realname', 'boss' FROM events
UNION ALL SELECT cast(event_id AS varchar), 'baseInfo', 'changeTimestamp', cast(event_id * 1000 + 1 AS varchar) FROM events
UNION ALL SELECT cast(event_id AS varchar), 'customField', 'CustomField_1', cast(round(value, 2) AS varchar) FROM events""")(_crm)

# ----------------------------------------------------------------- answers


# a small graph whose nodes are named by words of the questions; no relation leads on from where it ends
_NODES = """SELECT * FROM (VALUES ('n1', 'the'), ('n2', 'and of'), ('n3', 'die'), ('n4', 'que'), ('n5', 'les'), ('d1', 'thing is'), ('d2', 'der und'), ('d3', 'ment la')) AS t(id, name)"""
_RELATIONS = """SELECT * FROM (VALUES ('n1', 'is that', 'd1'), ('n2', 'is in', 'd1'), ('n2', 'with it', 'd2'), ('n3', 'der in', 'd2'), ('n4', 'de la', 'd3'), ('n5', 'la de', 'd3')) AS t(src, type, dst)"""
_ASKED = "CASE item_id % 4 WHEN 0 THEN 'business' WHEN 1 THEN 'work' WHEN 2 THEN 'unknown' ELSE '' END"
_AT, _SOON = "2024-01-31 00:00:00", "2024-01-31 00:05:00"


def _answers(v, folder, prefix, schema):
    """Request id and answer of all keys that are alive."""
    live = sinks.read_keyed(v.spark, folder, F.lit(_SOON).cast("timestamp"))
    return live.select(F.expr(f"substr(key, {len(prefix) + 1})").alias("request"), F.from_json("value", schema).alias("r"))


def _qa(v):
    folder = session.scratch(v.spark, "answers")
    msgs = _stream(v, "benchmark").select(F.col("item_id").cast("string").alias("key"), F.to_json(F.struct(
        F.col("item_id").cast("string").alias("questionId"), F.col("text").alias("question"), F.expr(_ASKED).alias("category"))).alias("value"))
    _run(v, msgs, J.question_job(v.knowledge, folder, v.sql(_NODES), v.sql(_RELATIONS), at=_AT))
    out = _answers(v, folder, "robot_res_", "array<struct<level:int,id:bigint,overlap:int,score:double,way:string>>")
    return out.select(F.col("request").cast("bigint").alias("question_id"), F.explode("r").alias("a")).select("question_id", "a.*")


def _qa_rounds(words, name):
    """Best entries for the words of a question among those its category may see."""
    return f"""
{name}p AS (SELECT question_id, k.id, count(*) AS overlap, any_value(len(kt)) AS n FROM {words} JOIN (SELECT id, category, kt, unnest(kt) AS token FROM k) k USING (token)
  WHERE k.category = cat OR k.category = '默认' GROUP BY 1, 2),
{name}m AS (SELECT *, max(overlap) OVER (PARTITION BY question_id) AS top FROM {name}p),
{name}r AS (SELECT question_id, id, overlap, round(overlap / n, 2) AS score FROM {name}m WHERE overlap = top),
{name} AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS level FROM {name}r)"""


query("stream_qa", f"""
WITH k AS (SELECT id, category, query, {TOK.format("regexp_replace(query, '[0-9]+', '', 'g')")} AS kt FROM knowledge),
q AS (SELECT item_id AS question_id, text AS question, CASE WHEN {_ASKED} IN (SELECT category FROM k) THEN {_ASKED} ELSE '默认' END AS cat FROM benchmark),
w AS (SELECT question_id, cat, unnest({TOK.format('question')}) AS token FROM q), {_qa_rounds('w', 'qa')},
b AS (SELECT question_id, max(score) AS best FROM qa GROUP BY 1),
weak AS (SELECT q.question_id, cat FROM q LEFT JOIN b USING (question_id) WHERE coalesce(best, 0) < 0.5),
nd AS ({_NODES}), ed AS ({_RELATIONS}),
nw AS (SELECT id, unnest({TOK.format('name')}) AS token FROM nd),
seed AS (SELECT DISTINCT question_id, id FROM weak JOIN w USING (question_id) JOIN nw USING (token)),
fst AS (SELECT question_id, src, type, dst FROM seed JOIN ed ON src = id),
cnt AS (SELECT question_id, count(*) AS n FROM seed GROUP BY 1),
dup AS (SELECT question_id, dst FROM fst GROUP BY 1, 2 HAVING count(*) > 1),
rel0 AS (SELECT f.* FROM fst f JOIN cnt USING (question_id) WHERE n < 2 OR question_id NOT IN (SELECT question_id FROM dup) OR (question_id, dst) IN (SELECT question_id, dst FROM dup)),
rel AS (SELECT DISTINCT r.question_id, src, type, dst FROM (SELECT *, unnest({TOK.format('type')}) AS token FROM rel0) r JOIN w ON w.question_id = r.question_id AND w.token = r.token),
said AS (SELECT DISTINCT question_id, unnest({TOK.format("concat_ws(' ', x.name, type, y.name)")}) AS token FROM rel JOIN nd x ON x.id = src JOIN nd y ON y.id = dst),
sw AS (SELECT question_id, cat, token FROM said JOIN q USING (question_id)), {_qa_rounds('sw', 'gr')}
SELECT question_id, cast(level AS int) AS level, id, cast(overlap AS int) AS overlap, score, CASE WHEN best >= 0.5 THEN 'overlap' ELSE 'weak overlap' END AS way
FROM qa JOIN b USING (question_id) WHERE level <= 6 AND question_id NOT IN (SELECT question_id FROM rel)
UNION ALL SELECT question_id, cast(level AS int), id, cast(overlap AS int), score, 'graph' FROM gr WHERE level <= 6
UNION ALL SELECT question_id, 1, min(id), 0, 0.0, 'contained' FROM q JOIN k ON contains(query, question) AND (category = cat OR category = '默认')
WHERE length(question) > 0 AND question_id NOT IN (SELECT question_id FROM b) AND question_id NOT IN (SELECT question_id FROM rel) GROUP BY 1""")(_qa)

_STANDARD = """
SELECT p_partkey AS id, concat(p_name, ' ', lower(p_type), ' hand') AS name, p_type AS profession, cast(p_size AS string) AS level,
  concat('Insurer ', p_brand, ' Ltd') AS company FROM part"""
_MAPPING = "SELECT DISTINCT p_name AS work_type, concat('std ', p_name) AS work_mapping, min(p_partkey) OVER (PARTITION BY p_name) AS id FROM part"
_REQ = """
SELECT s_suppkey AS msg_id, CASE WHEN s_suppkey % 5 = 4 THEN 'nobody' ELSE concat('Insurer Brand#', cast(s_suppkey % 25 + 1 AS string), ' Ltd of town') END AS company,
  CASE s_suppkey % 4 WHEN 0 THEN 'small ring' WHEN 1 THEN 'widget blue unknown' WHEN 2 THEN 'red' ELSE 'zzzz' END AS search FROM supplier"""


def _job_types(v):
    folder = session.scratch(v.spark, "jobtypes")
    s = _stream(v, "supplier")
    msgs = s.select(F.col("s_suppkey").cast("string").alias("key"), F.to_json(F.struct(
        F.col("s_suppkey").cast("string").alias("msgId"),
        F.expr("CASE WHEN s_suppkey % 5 = 4 THEN 'nobody' ELSE concat('Insurer Brand#', cast(s_suppkey % 25 + 1 AS string), ' Ltd of town') END").alias("insuranceCompany"),
        F.expr("CASE s_suppkey % 4 WHEN 0 THEN 'small ring' WHEN 1 THEN 'widget blue unknown' WHEN 2 THEN 'red' ELSE 'zzzz' END").alias("searchStr"))).alias("value"))
    _run(v, msgs, J.job_type_job(v.sql(_STANDARD), v.sql(_MAPPING), folder, at=_AT))
    fields = "work_code int, work_name string, profession string, work_level string, way string, mapped string"
    return _answers(v, folder, "worktype_search_", fields).select(F.col("request").cast("bigint").alias("msg_id"), "r.*")


query("stream_job_type_search", f"""
WITH st AS ({_STANDARD}), mp AS ({_MAPPING}), rq AS ({_REQ}),
cand AS (SELECT msg_id, search, st.* FROM rq JOIN st ON contains(rq.company, st.company) OR contains(st.company, rq.company)),
ins AS (SELECT msg_id, id, name, profession, level, 'contained' AS way, row_number() OVER (PARTITION BY msg_id ORDER BY length(name), name, id) AS k FROM cand WHERE contains(name, search)),
tk AS (SELECT id, unnest({TOK.format('name')}) AS token, len({TOK.format('name')}) AS n FROM st),
ov AS (SELECT c.msg_id, c.id, c.name, c.profession, c.level, c.company, count(*) AS o, any_value(n) AS n FROM cand c JOIN tk USING (id)
  WHERE list_contains({TOK.format('search')}, token) GROUP BY 1, 2, 3, 4, 5, 6),
ob AS (SELECT *, max(o) OVER (PARTITION BY msg_id, company) AS top FROM ov),
o1 AS (SELECT *, row_number() OVER (PARTITION BY msg_id, company ORDER BY round(o / n, 2) DESC, id) AS k FROM ob WHERE o = top),
ch AS (SELECT msg_id, id, name, profession, level, way FROM ins WHERE k = 1 UNION ALL
  SELECT msg_id, id, name, profession, level, 'overlap' FROM o1 WHERE k = 1 AND msg_id NOT IN (SELECT msg_id FROM ins)),
c1 AS (SELECT *, row_number() OVER (PARTITION BY msg_id ORDER BY length(name), name, id) AS k FROM ch),
mt AS (SELECT id, work_mapping, unnest({TOK.format('work_type')}) AS token, len({TOK.format('work_type')}) AS n FROM mp),
mo AS (SELECT msg_id, id, work_mapping, count(*) AS o, any_value(n) AS n FROM rq JOIN mt ON list_contains({TOK.format('search')}, token) GROUP BY 1, 2, 3),
mm AS (SELECT *, max(o) OVER (PARTITION BY msg_id) AS top FROM mo),
mr AS (SELECT *, row_number() OVER (PARTITION BY msg_id ORDER BY round(o / n, 2) DESC, id) AS k FROM mm WHERE o = top),
ml AS (SELECT msg_id, string_agg(work_mapping, '|' ORDER BY k) AS mapped FROM mr WHERE k <= 5 GROUP BY 1)
SELECT rq.msg_id, c1.id AS work_code, c1.name AS work_name, c1.profession, c1.level AS work_level, c1.way, mapped
FROM rq LEFT JOIN c1 ON c1.msg_id = rq.msg_id AND k = 1 LEFT JOIN ml ON ml.msg_id = rq.msg_id""")(_job_types)


def _payout(v):
    folder = session.scratch(v.spark, "payouts")
    vocab = session.materialise(MT.vocab_frequent(v.documents, length=4, chinese_only=False), "vocab")
    msgs = _stream(v, "benchmark").select(F.col("item_id").cast("string").alias("key"), F.to_json(F.struct(
        F.col("item_id").cast("string").alias("caseId"), "text", F.col("item_id").cast("string").alias("policyNo"))).alias("value"))
    _run(v, msgs, J.payout_job(_history(v), vocab, BRANCHES, folder))
    return v.spark.read.parquet(folder).drop("batch").withColumn("case_id", F.col("case_id").cast("bigint"))


query("stream_payout_estimate", PAYOUT_SQL.replace("{amount}", "CASE WHEN coalesce(mean, 0) = 0 THEN 4000 ELSE mean END"))(_payout)
