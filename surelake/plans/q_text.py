"""Scalar functions, text and name matching, graph, risk features."""

from pyspark.sql import functions as F

from .. import session
from ..functions import scalars as S
from ..operators import claim as C
from ..operators import graph as G
from ..operators import automaton as AM
from ..operators import matching as MT
from ..sources import files
from .catalog import query
from .views import AS_OF

TOK = "list_distinct(regexp_extract_all(lower({}), '[a-z一-龥]{{2,}}'))"

# ------------------------------------------------------------------ scalars

query("clean_amount", """
SELECT id, cast(CASE WHEN regexp_matches(pre_com, '[一-龥]') THEN NULL ELSE try_cast(pre_com AS decimal(20,4)) END AS double) AS pre_com,
  cast(try_cast(nullif(final_payment, '') AS decimal(20,4)) AS double) AS final_payment FROM claims""")(
    lambda v: v.claims.select("id", S.clean_amount("pre_com").cast("double").alias("pre_com"), S.clean_amount("final_payment").cast("double").alias("final_payment"))
)
query("clean_name", """
SELECT id, regexp_replace(name, '[^一-龥]', '', 'g') AS name, replace(cert_no, chr(10), '') AS cert_no FROM v1_person""")(
    lambda v: v.v1_person.select("id", S.keep_chinese("name").alias("name"), S.drop_newlines("cert_no").alias("cert_no"))
)
query("id_card_valid", """
SELECT DISTINCT insured_cert_no, regexp_full_match(insured_cert_no, '[1-9]\\d{5}[1-9]\\d{3}((0\\d)|(1[0-2]))(([0|1|2]\\d)|3[0-1])((\\d{4})|\\d{3}[A-Z])') AS valid
FROM insured""")(lambda v: v.insured.select("insured_cert_no", S.id_card_valid("insured_cert_no").alias("valid")).distinct())
_BORN = "strptime(substr(insured_cert_no, 7, 8), '%Y%m%d')"
query("id_card_age", f"""
SELECT insured_id, greatest(year(insured_start_date) - year({_BORN}) + CASE WHEN month(insured_start_date) * 100 + day(insured_start_date)
    >= month({_BORN}) * 100 + day({_BORN}) THEN 1 ELSE 0 END, 0) AS age,
  cast(floor(date_diff('day', {_BORN}, insured_start_date) / 365) + 1 AS int) AS age_days,
  cast(round(date_diff('day', {_BORN}, insured_start_date) / 365) AS int) AS age_rounded FROM insured_term""")(
    lambda v: v.insured_term.select(
        "insured_id", S.id_age("insured_cert_no", "insured_start_date").alias("age"),
        S.id_age_by_days("insured_cert_no", "insured_start_date").alias("age_days"),
        S.id_age_rounded("insured_cert_no", "insured_start_date").alias("age_rounded"))
)
query("text_flags", """
SELECT doc_id, cast(regexp_matches(text, '[A-Za-z]') AS int) AS has_latin, cast(regexp_matches(text, '[0-9]') AS int) AS has_digit,
  cast(regexp_matches(text, '[一-龥]') AS int) AS has_chinese FROM documents""")(
    lambda v: MT.text_flags(v.documents.select("doc_id", "text"), "text").drop("text")
)
query("month_shift", """
SELECT DISTINCT month_id, strftime(strptime(concat(month_id, '01'), '%Y%m%d') - INTERVAL 3 MONTH, '%Y%m') AS three_before,
  strftime(strptime(concat(month_id, '01'), '%Y%m%d') + INTERVAL 1 MONTH, '%Y%m') AS next_month FROM ent_month""")(
    lambda v: v.ent_month.select("month_id", S.shift_month("month_id", -3).alias("three_before"), S.shift_month("month_id", 1).alias("next_month")).distinct()
)
query("whole_months", f"""
SELECT policy_id, (year(d) - year(s)) * 12 + month(d) - month(s) - CASE WHEN day(d) >= least(day(s), day(last_day(d))) THEN 0 ELSE 1 END AS months,
  year(d) - year(s) - CASE WHEN month(d) * 100 + day(d) >= month(s) * 100 + day(s) THEN 0 ELSE 1 END AS years
FROM (SELECT policy_id, start_date AS s, DATE '{AS_OF}' AS d FROM policy)""")(
    lambda v: v.policy.select("policy_id", S.whole_months("start_date", F.lit(AS_OF)).alias("months"), S.completed_years("start_date", F.lit(AS_OF)).alias("years"))
)
VALUE_SQL = """
e AS (SELECT ent_id, CASE WHEN people < 1000 THEN 30 * (people / 1000) WHEN people < 5000 THEN 20 * ((people - 1000) / 4000) + 30
    WHEN people < 10000 THEN 30 * ((people - 5000) / 5000) + 50 WHEN people < 50000 THEN 20 * ((people - 10000) / 40000) + 80 ELSE 0 END AS a,
  CASE WHEN premium < 1e5 THEN 50 * (premium / 1e5) WHEN premium < 6e5 THEN 30 * ((premium - 1e5) / 5e5) + 50
    WHEN premium < 2e6 THEN 20 * ((premium - 6e5) / 1.4e6) + 80 ELSE 0 END AS b,
  CASE WHEN growth < 0 THEN 0 WHEN growth < 50 THEN 50 * (growth / 50) WHEN growth < 100 THEN 50 * ((growth - 50) / 50) + 50 ELSE 100 END AS c FROM t),
s AS (SELECT ent_id, cast(round(cast(a AS decimal(20,8)), 2) AS double) AS a, cast(round(cast(b AS decimal(20,8)), 2) AS double) AS b,
  cast(round(cast(c AS decimal(20,8)), 2) AS double) AS c FROM e)"""
query("value_score", f"""
WITH t AS (SELECT ent_id, cast(count(*) * 400 AS double) AS people, cast(sum(premium) AS double) / 4 AS premium, cast(count(*) * 7 - 30 AS double) AS growth
  FROM policy GROUP BY 1),
{VALUE_SQL}
SELECT ent_id, round(a * 0.3::DOUBLE + b * 0.35::DOUBLE + c * 0.35::DOUBLE, 4) AS score FROM s""")(
    lambda v: v.policy.groupBy("ent_id").agg(
        (F.count("*") * 400).cast("double").alias("people"), (F.sum("premium").cast("double") / 4).alias("premium"),
        (F.count("*") * 7 - 30).cast("double").alias("growth"),
    ).select("ent_id", F.round(S.value_score("people", "premium", "growth"), 4).alias("score"))
)
query("alert_json_fix", """
SELECT event_id, CASE WHEN value > 15 THEN '{"ringRatio":"0.0000","k":"x"}' ELSE '{"ringRatio":"0.5","k":"x"}' END AS payload FROM events""")(
    lambda v: v.events.select("event_id", F.when(F.col("value") > 15, F.lit('{"ringRatio": "Infinity", "k": "x"}')).otherwise('{"ringRatio": "0.5", "k": "x"}').alias("p"))
    .select("event_id", S.patch_json_map("p", "Infinity", "0.0000").alias("payload"))
)
query("row_to_json", "SELECT n_nationkey, cast(json_object('n_nationkey', n_nationkey, 'n_name', n_name, 'n_regionkey', n_regionkey) AS varchar) AS doc FROM nation")(
    lambda v: v.nation.select("n_nationkey", F.to_json(F.struct("*")).alias("doc"))
)

# ----------------------------------------------------------------- matching

query("vocab_frequent", f"""
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z一-龥]{{2,}}')) AS token FROM documents) WHERE length(token) = 4
GROUP BY 1 HAVING count(*) >= 10""")(lambda v: MT.vocab_frequent(v.documents, length=4, chinese_only=False))

QA_BEST = f"""
k AS (SELECT id, {TOK.format("regexp_replace(query, '[0-9]+', '', 'g')")} AS kt FROM knowledge),
voc AS (SELECT DISTINCT unnest(kt) AS token FROM k),
q AS (SELECT question_id, token FROM (SELECT question_id, unnest({TOK.format('question')}) AS token FROM questions) JOIN voc USING (token)),
p AS (SELECT question_id, id, count(*) AS overlap, any_value(len(kt)) AS n FROM q JOIN (SELECT id, kt, unnest(kt) AS token FROM k) USING (token) GROUP BY 1, 2),
m AS (SELECT *, max(overlap) OVER (PARTITION BY question_id) AS top FROM p),
r AS (SELECT question_id, id, overlap, round(overlap / n, 2) AS score FROM m WHERE overlap = top),
qa AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS level FROM r)"""
query("qa_topk", f"WITH {QA_BEST} SELECT question_id, level, id, cast(overlap AS int) AS overlap, score FROM qa WHERE level <= 6")(
    lambda v: MT.qa_topk(v.questions, v.knowledge)
)
_FRAG = "SELECT conv_id * 1000 + turn AS question_id, trim(text) AS question FROM conversations WHERE role = 'user'"
query("qa_exact_fallback", f"""
WITH f AS ({_FRAG}) SELECT question_id, min(id) AS id FROM f JOIN knowledge ON contains(query, question) WHERE length(question) > 0 GROUP BY 1""")(
    lambda v: MT.qa_exact(v.sql(_FRAG), v.knowledge)
)
query("qa_with_fallback", f"""
WITH {QA_BEST.replace('FROM questions', f"FROM ({_FRAG})")}, b AS (SELECT question_id, max(score) AS best FROM qa WHERE level <= 6 GROUP BY 1)
SELECT question_id, level, id, cast(overlap AS int) AS overlap, score, CASE WHEN best >= 0.5 THEN 'overlap' ELSE 'weak overlap' END AS way
FROM qa JOIN b USING (question_id) WHERE level <= 6
UNION ALL SELECT question_id, 1, min(id), 0, 0.0, 'contained' FROM ({_FRAG}) JOIN knowledge ON contains(query, question)
WHERE length(question) > 0 AND question_id NOT IN (SELECT question_id FROM b) GROUP BY 1""")(
    lambda v: MT.qa_with_fallback(v.sql(_FRAG), v.knowledge)
)

BRANCHES = [("fracture", ["der", "ren"]), ("surgery", ["ing"])]
_BR = "CASE WHEN contains(text, 'der') OR contains(text, 'ren') THEN 'fracture' WHEN contains(text, 'ing') THEN 'surgery' ELSE 'other' END"


def _cases(v):
    return v.benchmark.select(F.col("item_id").alias("case_id"), "text", F.col("item_id").alias("policy_no"))


def _history(v):
    return v.documents.select("text", F.col("n_chars").alias("payout"))


def _cover(v):
    return v.benchmark.select(F.col("item_id").alias("policy_no"), (F.col("item_id") * 100 + 300).alias("medical_cover"), F.lit(30).alias("coverage"))


PAYOUT_SQL = f"""
WITH voc AS (SELECT token FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z一-龥]{{2,}}')) AS token FROM documents) WHERE length(token) = 4 GROUP BY 1 HAVING count(*) >= 10),
h AS (SELECT row_number() OVER () AS hid, {_BR} AS branch, n_chars AS payout, {TOK.format("regexp_replace(text, '[0-9]+', '', 'g')")} AS t FROM documents WHERE n_chars <> 0),
ht AS (SELECT hid, branch, payout, token FROM (SELECT hid, branch, payout, unnest(t) AS token FROM h) JOIN voc USING (token)),
c AS (SELECT item_id AS case_id, {_BR} AS branch, {TOK.format('text')} AS t, text FROM benchmark),
p AS (SELECT case_id, hid, any_value(payout) AS payout, count(*) AS o FROM (SELECT case_id, branch, unnest(t) AS token FROM c) JOIN ht USING (branch, token) GROUP BY 1, 2),
m AS (SELECT *, max(o) OVER (PARTITION BY case_id) AS top FROM p),
e AS (SELECT case_id, count(*) AS n_similar, sum(payout) // count(*) AS mean FROM m WHERE o >= top - 1 GROUP BY 1)
SELECT case_id, branch, coalesce(n_similar, 0) AS n_similar, cast({{amount}} AS bigint) AS payout
FROM c LEFT JOIN e USING (case_id)"""
query("payout_estimate", PAYOUT_SQL.replace(
    "{amount}", "CASE WHEN contains(text, 'ouen') THEN 300000 ELSE least(coalesce(mean, 0), case_id * 100 + 300) END"))(
    lambda v: MT.payout_estimate(
        _cases(v), _history(v), BRANCHES, MT.vocab_frequent(v.documents, length=4, chinese_only=False), _cover(v), death_words=["ouen"])
)

_INV = "SELECT p_partkey AS id, replace(p_name, 'e', '') AS purchaser_name FROM part"
_CHARS = """
tf AS (SELECT name, c, count(*) AS n FROM (SELECT name, unnest(string_split(name, '')) AS c FROM (SELECT DISTINCT name FROM ({names}))) WHERE c <> '' GROUP BY 1, 2),
nm AS (SELECT name, sqrt(sum(n * n)) AS norm FROM tf GROUP BY 1)"""
_COS = """
pn AS (SELECT DISTINCT replace(p_name, 'e', '') AS name FROM part), hn AS (SELECT DISTINCT p_name AS name FROM part),
dot AS (SELECT a.name AS p, b.name AS h, sum(a.n * b.n) AS d FROM tf a JOIN tf b ON a.c = b.c
  WHERE a.name IN (SELECT name FROM pn) AND b.name IN (SELECT name FROM hn) GROUP BY 1, 2),
cs AS (SELECT p, h, round(least(d / (x.norm * y.norm), 1.0), 4) AS s FROM dot JOIN nm x ON x.name = p JOIN nm y ON y.name = h),
best AS (SELECT p, h, s, row_number() OVER (PARTITION BY p ORDER BY s DESC, h) AS k FROM cs)"""
_NAMES = "SELECT p_name AS name FROM part UNION SELECT replace(p_name, 'e', '') FROM part"
_SIM = f"WITH inv AS ({_INV}), {_CHARS.format(names=_NAMES)}, {_COS} SELECT id, purchaser_name, h AS purchaser_res, s AS similarity FROM inv JOIN best ON p = purchaser_name AND k = 1"


def _invoices(v):
    return v.sql(_INV)


def _holders(v):
    return v.part.select(F.col("p_name").alias("holder_name"))


query("name_similarity", _SIM)(lambda v: MT.name_similarity(_invoices(v), _holders(v)))
query("name_match_incremental", f"{_SIM} AND id NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)")(
    lambda v: MT.name_similarity(_invoices(v), _holders(v), v.part.where("p_size > 25").select(F.col("p_partkey").alias("id")))
)
_THREE = ("small ring", "red widget", "blue bolt")
query("name_similarity_fixed", f"""
WITH {_CHARS.format(names="SELECT p_name AS name FROM part UNION SELECT unnest(['small ring', 'red widget', 'blue bolt'])")},
f AS (SELECT a.name AS nme, b.name AS h, least(sum(a.n * b.n) / (any_value(x.norm) * any_value(y.norm)), 1.0) AS s FROM tf a JOIN tf b ON a.c = b.c
  JOIN nm x ON x.name = a.name JOIN nm y ON y.name = b.name WHERE b.name IN ('small ring', 'red widget', 'blue bolt') GROUP BY 1, 2),
w AS (SELECT p_name, coalesce(max(s) FILTER (h = 'small ring'), 0) AS a, coalesce(max(s) FILTER (h = 'red widget'), 0) AS b, coalesce(max(s) FILTER (h = 'blue bolt'), 0) AS c
  FROM (SELECT DISTINCT p_name FROM part) LEFT JOIN f ON nme = p_name GROUP BY 1),
g AS (SELECT *, round(greatest(a, b, c), 10) AS t FROM w)
SELECT p_partkey AS req_id, part.p_name AS seller_name, round(a, 10) AS s1, round(b, 10) AS s2, round(c, 10) AS s3,
  CASE WHEN (round(a,10) = t)::int + (round(b,10) = t)::int + (round(c,10) = t)::int > 1 THEN '相似度有误' WHEN round(a,10) = t THEN 'small ring'
    WHEN round(b,10) = t THEN 'red widget' ELSE 'blue bolt' END AS seller_res FROM part JOIN g USING (p_name)""")(
    lambda v: (lambda d: d.select("req_id", "seller_name", *[F.round(c, 10).alias(c) for c in ("s1", "s2", "s3")], "seller_res"))(
        MT.name_similarity_fixed(v.part.select(F.col("p_partkey").alias("req_id"), F.col("p_name").alias("seller_name")), _THREE))
)
query("shared_people", """
WITH d AS (SELECT DISTINCT holder_company AS h, insured_cert_no AS c FROM policy JOIN insured USING (policy_id)
  WHERE insure_code IN (SELECT product_code FROM product WHERE dim_1 IN ('外包雇主', '骑士保', '大货车')))
SELECT a.h AS holder1, b.h AS holder2, count(*) AS equal_count FROM d a JOIN d b ON a.c = b.c AND a.h < b.h GROUP BY 1, 2""")(
    lambda v: MT.shared_people(
        v.insured.select("policy_id", F.col("insured_cert_no").alias("person")).join(
            v.policy.join(v.product.where(F.col("dim_1").isin("外包雇主", "骑士保", "大货车")).select("product_code"),
                          F.col("insure_code") == F.col("product_code"), "left_semi").select("policy_id", F.col("holder_company").alias("holder")), "policy_id"))
)
_STD = "SELECT p_partkey AS id, concat(lower(p_type), ' ', p_name, ' maker') AS stype FROM part"
query("worktype_standardise", f"""
WITH s AS (SELECT id, stype, unnest(list_distinct(regexp_extract_all(lower(stype), '[a-z一-龥]{{2,}}'))) AS token FROM ({_STD})),
n AS (SELECT name, unnest(list_distinct(regexp_extract_all(lower(name), '[a-z一-龥]{{2,}}'))) AS token FROM (SELECT DISTINCT p_name AS name FROM part))
SELECT DISTINCT id, stype, name, CASE WHEN contains(lower(stype), lower(name)) THEN stype ELSE '-1' END AS result FROM s JOIN n USING (token)""")(
    lambda v: MT.worktype_standardise(v.sql(_STD), v.part.select(F.col("p_name").alias("name")))
)
query("claim_nearest_policy", """
WITH c AS (SELECT cert_no, cast(try_strptime(risk_date, '%Y/%m/%d') AS date) AS d, cast(try_strptime(report_date, '%Y/%m/%d') AS date) AS r,
  coalesce(CASE WHEN regexp_matches(coalesce(nullif(final_payment, ''), pre_com), '[一-龥]') THEN NULL
    ELSE cast(try_cast(coalesce(nullif(final_payment, ''), pre_com) AS decimal(20,4)) AS double) END, 0) AS a FROM claims),
p AS (SELECT cert_no, d, r, a, date_diff('day', insured_start_date, d) AS gap FROM c JOIN (SELECT DISTINCT insured_cert_no, insured_start_date FROM insured_term)
  ON cert_no = insured_cert_no WHERE r IS NOT NULL AND d > insured_start_date),
k AS (SELECT *, row_number() OVER (PARTITION BY cert_no ORDER BY gap, d, r, a) AS n FROM p)
SELECT cert_no, cast(date_diff('day', d, r) + 1 AS int) AS report_days, cast(gap + 1 AS int) AS risk_days, a AS amount FROM k WHERE n = 1""")(
    lambda v: MT.claim_nearest_policy(v.claims, v.insured_term)
)

# --------------------------------------------------------------------- logs

LOG = """
SELECT substr(value, 1, 23) AS time, substr(value, 25, 7) AS level, trim(regexp_extract(substr(value, 33), '\\(([^)]*)\\)', 1)) AS class,
  trim(substr(t, instr(t, '-') + 1)) AS cause FROM (SELECT value, substr(substr(value, 33), instr(substr(value, 33), ']') + 1) AS t FROM log_lines)"""


def _log_files(v):
    """The log as text files, read as a job reads them."""
    path = session.scratch(v.spark, "log")
    v.log_lines.select("value").write.text(path)
    return files.text_lines(v.spark, f"{path}/*.txt")


query("log_parse", LOG)(lambda v: MT.log_parse(_log_files(v)))
query("log_error_groups", f"""
SELECT level, class, cause, count(*) AS n, max(time) AS latest FROM ({LOG}) WHERE level = '[ERROR]' AND cause <> '' GROUP BY 1, 2, 3""")(
    lambda v: MT.log_error_groups(MT.log_parse(_log_files(v)))
)
query("block_text_records", """
SELECT doc_id, i - 1 AS block, list_extract(parts, i) AS record FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
  FROM (SELECT doc_id, list_filter(string_split(text, chr(10) || chr(10)), lambda x: regexp_matches(x, '\\S')) AS parts FROM documents))""")(
    lambda v: files.blocks(v.documents.select("doc_id", "text"), "text", ["doc_id"])
)


def _block_files(v):
    """One whole file per record set: supplier records of a nation, parted by blank lines."""
    path = session.scratch(v.spark, "blocks")
    record = F.concat(F.lit("supplier "), F.col("s_suppkey").cast("string"), F.lit("\n"), F.col("s_name"))
    v.supplier.select("s_nationkey", F.concat(record, F.lit("\n\n")).alias("value")).repartition("s_nationkey").write.partitionBy("s_nationkey").option("lineSep", "\n").text(path)
    found = files.text_blocks(v.spark, f"{path}/*/*.txt")
    return found.select(F.regexp_extract("file", "s_nationkey=([0-9]+)", 1).cast("int").alias("s_nationkey"), F.trim(F.regexp_replace("record", "^\\s+|\\s+$", "")).alias("record"))


query("text_file_blocks", "SELECT s_nationkey, concat('supplier ', s_suppkey, chr(10), s_name) AS record FROM supplier")(_block_files)
# two-word phrases of the benchmark and single words of product names in all documents, whole texts in one pass
_PHRASES = """SELECT DISTINCT needle FROM (SELECT concat(split_part(text, ' ', 2), ' ', split_part(text, ' ', 3)) AS needle FROM benchmark
UNION ALL SELECT split_part(p_name, ' ', 1) FROM part) AS t WHERE length(needle) > 1"""
query("keywords_in_documents", f"SELECT needle AS qid, doc_id AS kid FROM documents JOIN ({_PHRASES}) ON contains(text, needle)")(
    lambda v: AM.containing_once(v.sql(_PHRASES).select(F.col("needle").alias("qid"), "needle"), v.documents.select(F.col("doc_id").alias("kid"), "text"))
)
query("text_cross_expand", "SELECT s_suppkey, s_name, unnest(['a', 'b', 'c']) AS plan FROM supplier")(
    lambda v: MT.cross_expand(v.supplier.select("s_suppkey", "s_name"), ["a", "b", "c"], "plan")
)
_LOGGED = """
SELECT p_name AS asked, CASE WHEN p_size > 40 THEN '{"standardWork": null}' ELSE concat('{"standardWork": {"workName": "', replace(p_name, 'red', 'blue'),
  '", "insuranceCompany": "', p_brand, '"}}') END AS payload FROM part"""
query("match_audit", """
SELECT p_name AS asked, CASE WHEN p_size > 40 THEN 'null' ELSE replace(p_name, 'red', 'blue') END AS work_name, CASE WHEN p_size > 40 THEN 'null' ELSE p_brand END AS company,
  CASE WHEN p_size > 40 THEN 'null' WHEN p_name = replace(p_name, 'red', 'blue') THEN '1' ELSE '2' END AS match FROM part""")(
    lambda v: MT.match_audit(v.sql(_LOGGED))
)

# -------------------------------------------------------------------- graph

_EDGES = """
SELECT DISTINCT concat('part ', cast(l_partkey AS string)) AS src, 'supplied by' AS type, concat('supplier ', cast(l_suppkey AS string)) AS dst FROM lineitem
UNION SELECT concat('supplier ', cast(s_suppkey AS string)), 'located in', n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
_SEEDS = "SELECT concat('part ', cast(p_partkey AS string)) AS id FROM part WHERE p_type = 'PROMO' AND p_size < 10"
_CHAIN = """
SELECT concat('order ', cast(o_orderkey AS string)) AS src, 'placed by' AS type, concat('customer ', cast(o_custkey AS string)) AS dst FROM orders
UNION ALL SELECT concat('customer ', cast(c_custkey AS string)), 'lives in', concat('nation ', cast(c_nationkey AS string)) FROM customer
UNION ALL SELECT concat('nation ', cast(n_nationkey AS string)), 'part of', concat('region ', cast(n_regionkey AS string)) FROM nation"""
_PAIRS = """
SELECT o_orderkey AS q, concat('order ', cast(o_orderkey AS string)) AS id FROM orders
UNION ALL SELECT a.o_orderkey, concat('order ', cast(b.o_orderkey AS string)) FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1"""
# two orders meet at a customer, a nation or a region, or nowhere; an order without a next one is a single seed
query("graph_k_hop_each", """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, c_nationkey AS n, n_regionkey AS r FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT a.k AS q, a.k AS ak, a.c AS ac, a.n AS an, a.r AS ar, b.k AS bk, b.c AS bc, b.n AS bn, b.r AS br FROM o a LEFT JOIN o b ON b.k = a.k + 1),
m AS (SELECT *, CASE WHEN bk IS NULL THEN 0 WHEN ac = bc THEN 1 WHEN an = bn THEN 2 WHEN ar = br THEN 3 ELSE 0 END AS lv FROM p)
SELECT DISTINCT q, src, type, dst FROM (
  SELECT q, concat('order ', ak) AS src, 'placed by' AS type, concat('customer ', ac) AS dst FROM m WHERE lv IN (0, 1)
  UNION ALL SELECT q, concat('order ', bk), 'placed by', concat('customer ', bc) FROM m WHERE lv IN (0, 1) AND bk IS NOT NULL
  UNION ALL SELECT q, concat('customer ', ac), 'lives in', concat('nation ', an) FROM m WHERE lv = 2
  UNION ALL SELECT q, concat('customer ', bc), 'lives in', concat('nation ', bn) FROM m WHERE lv = 2
  UNION ALL SELECT q, concat('nation ', an), 'part of', concat('region ', ar) FROM m WHERE lv = 3
  UNION ALL SELECT q, concat('nation ', bn), 'part of', concat('region ', br) FROM m WHERE lv = 3)""")(
    lambda v: G.k_hop_each(v.sql(_PAIRS), v.sql(_CHAIN), ["q"])
)
query("graph_k_hop", f"""
WITH e AS ({_EDGES}), s AS ({_SEEDS}), h AS (SELECT e.* FROM e JOIN s ON src = id),
x AS (SELECT dst FROM h GROUP BY 1 HAVING count(*) > 1) SELECT src, type, dst FROM h WHERE dst IN (SELECT dst FROM x)""")(
    lambda v: G.k_hop(v.sql(_SEEDS), v.sql(_EDGES)).select("src", "type", "dst")
)
