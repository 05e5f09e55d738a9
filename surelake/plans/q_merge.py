"""Two-system merges, reconciliation, web and CRM marts, product flags, profiles."""

from pyspark.sql import functions as F

from .. import session
from ..functions import scalars as S
from ..operators import facts as FA
from ..operators import mart
from ..operators import merge as MG
from ..operators import profile as PF
from ..operators import recon as R
from ..operators import standing as ST
from ..operators import web as W
from .catalog import query
from .q_premium import PDAY, SCOPE, TODAY, scope
from .views import AS_OF, EVENT_AS_OF

RULES = MG.SourceRules(test_users=("9999",), prefix_product="15000001", code_prefix="PRE")
_CH = "regexp_replace({}, '[^一-龥]', '', 'g')"
_AGE = """CASE WHEN length({c}) = 18 AND {d} IS NOT NULL THEN greatest(year(cast({d} AS date)) - cast(substr({c}, 7, 4) AS int)
  + CASE WHEN month(cast({d} AS date)) * 100 + day(cast({d} AS date)) >= cast(substr({c}, 11, 4) AS int) THEN 1 ELSE 0 END, 0) ELSE 0 END"""
_KEEP = ["insured_id", "policy_id", "insured_type", "insured_name", "insured_work_type", "insured_cert_no", "insured_status",
         "insure_policy_status", "insured_start_date", "child_id", "child_policy_status", "is_chief_insurer", "age"]
_V1 = f"""
SELECT p.id AS insured_id, p.policy_id, NULL AS insured_type, {_CH.format('p.name')} AS insured_name, {_CH.format('p.work_type')} AS insured_work_type,
  replace(p.cert_no, chr(10), '') AS insured_cert_no, p.status AS insured_status, NULL AS insure_policy_status, p.start_date AS insured_start_date,
  c.id AS child_id, NULL AS child_policy_status, NULL AS is_chief_insurer,
  {_AGE.format(c="replace(p.cert_no, chr(10), '')", d="p.start_date")} AS age
FROM v1_person p LEFT JOIN v1_child c ON p.id = c.insured_id LEFT JOIN v1_policy o ON p.policy_id = o.id"""
query("merge_insured", f"""
{_V1} WHERE (user_id NOT IN ('9999') OR user_id IS NULL) AND (remark NOT IN ('obsolete') OR remark IS NULL)
UNION ALL {_V1} WHERE insure_code IN ('15000001') AND policy_code LIKE 'PRE%'
UNION ALL
SELECT p.id, o.id, '', {_CH.format('p.name')}, {_CH.format('p.work_type')}, p.cert_no, CASE p.status WHEN '1' THEN '0' ELSE '1' END,
  CASE WHEN p.status = '1' AND cast(end_date AS date) > DATE '{AS_OF}' AND cast(start_date AS date) < DATE '{AS_OF}' THEN '1' ELSE '2' END,
  start_date, c.id, CASE c.status WHEN '1' THEN '0' ELSE CASE WHEN c.id IS NULL THEN NULL ELSE '1' END END, '1',
  CASE WHEN cert_type = '1' AND start_date IS NOT NULL THEN {_AGE.format(c="p.cert_no", d="start_date")} END
FROM (SELECT id, policy_no, name, work_type, cert_no, cert_type, status, start_date, end_date FROM v2_person) p
LEFT JOIN v2_child c ON p.policy_no = c.policy_no LEFT JOIN (SELECT id, policy_no FROM v2_policy) o ON p.policy_no = o.policy_no""")(
    lambda v: MG.merge_insured(MG.insured_v1(v.v1_person, v.v1_child, v.v1_policy, RULES), MG.insured_v2(v.v2_person, v.v2_child, v.v2_policy, AS_OF)).select(*_KEEP)
)
_EDATES = """
SELECT preserve_id, CASE WHEN add_person_count = 0 AND del_person_count > 0 THEN NULL ELSE s END AS s,
  CASE WHEN add_person_count = 0 AND del_person_count > 0 THEN e + 1 ELSE e END AS e
FROM v1_endorse LEFT JOIN (SELECT preserve_id, max(coalesce(join_date, left_date)) AS s, min(coalesce(left_date, join_date)) AS e
  FROM v1_endorse_person WHERE remark <> 'obsolete' OR remark IS NULL GROUP BY 1) USING (preserve_id)"""
query("endorse_dates", f"SELECT preserve_id, cast(s AS varchar) AS pre_start_date, cast(e AS varchar) AS pre_end_date FROM ({_EDATES})")(
    lambda v: MG.endorse_dates(v.v1_endorse, v.v1_endorse_person).select(
        "preserve_id", F.col("pre_start_date").cast("string").alias("pre_start_date"), F.col("pre_end_date").cast("string").alias("pre_end_date"))
)
_EK = ["preserve_id", "policy_id", "policy_code", "preserve_status", "pre_start_date", "pre_end_date", "insured_name", "insured_cert_no",
       "insured_work_type", "insured_changetype", "join_date", "left_date"]
query("merge_endorse", f"""
SELECT cast(a.preserve_id AS varchar) AS preserve_id, coalesce(o.id, cast(a.policy_id AS varchar)) AS policy_id, a.policy_code, preserve_status,
  cast(s AS varchar) AS pre_start_date, cast(e AS varchar) AS pre_end_date, name AS insured_name, cert_no AS insured_cert_no,
  {_CH.format('work_type')} AS insured_work_type, change_type AS insured_changetype, cast(join_date AS varchar) AS join_date, cast(left_date AS varchar) AS left_date
FROM v1_endorse a JOIN ({_EDATES}) d USING (preserve_id) JOIN v1_endorse_person p USING (preserve_id)
LEFT JOIN (SELECT id, insurance_policy_no FROM v2_policy) o ON a.policy_code = insurance_policy_no WHERE remark <> 'obsolete' OR remark IS NULL
UNION ALL
SELECT a.preserve_id, o.id, insurance_policy_no, '4', CASE WHEN add_person_count = 0 AND del_person_count > 0 THEN NULL ELSE s END,
  CASE WHEN add_person_count = 0 AND del_person_count > 0 THEN cast(cast(e AS date) + 1 AS varchar) ELSE e END, {_CH.format('name')}, cert_no, work_type,
  revise_status, p.start_date, p.end_date
FROM v2_endorse a JOIN (SELECT policy_no, revise_no, max(coalesce(start_date, end_date)) AS s, min(coalesce(end_date, start_date)) AS e
  FROM v2_person GROUP BY 1, 2) USING (policy_no, revise_no) JOIN v2_person p USING (policy_no, revise_no)
LEFT JOIN (SELECT id, policy_no, insurance_policy_no FROM v2_policy) o USING (policy_no)""")(
    lambda v: MG.merge_endorse(
        MG.endorse_v1(v.v1_endorse, v.v1_endorse_person, v.v2_policy), MG.endorse_v2(v.v2_endorse, v.v2_person, v.v2_policy)
    ).select(*_EK)
)
_PK = ["policy_id", "order_id", "user_id", "policy_code", "insure_code", "pay_amount", "policy_status", "order_date", "holder_name", "office_province",
       "product_name", "sku_coverage", "sku_append", "sku_ratio", "sku_charge_type", "ent_id", "ent_name", "number_of_people", "system_source"]
query("merge_policy", f"""
SELECT p.policy_id, o.order_id, o.user_id, p.policy_code, insure_code, cast(CASE WHEN f.policy_id IS NOT NULL THEN f.pay_amount ELSE o.pay_amount END AS varchar) AS pay_amount,
  status AS policy_status, coalesce(order_date, order_create_time) AS order_date, holder_name, coalesce(office_province, holder_province) AS office_province,
  product_name, CASE WHEN length(term_three) = 5 THEN substr(term_three, 1, 2) ELSE term_one END AS sku_coverage,
  CASE WHEN length(term_three) = 5 THEN substr(term_three, 3, 1) END AS sku_append, CASE WHEN length(term_three) = 5 THEN substr(term_three, 5, 1) END AS sku_ratio,
  CASE WHEN length(term_three) = 5 THEN substr(term_three, 4, 1) END AS sku_charge_type, ent_id, ent_name, quantity AS number_of_people, '1.0' AS system_source
FROM v1_order o LEFT JOIN (SELECT * EXCLUDE (user_id) FROM v1_policy) p USING (order_id) LEFT JOIN v1_first_premium f ON f.policy_id = p.policy_id
LEFT JOIN product ON product_code = insure_code LEFT JOIN sku_term k ON k.sku_code = p.sku_id LEFT JOIN v1_holder h ON h.policy_id = p.policy_id
LEFT JOIN ent_map m ON m.policy_code = p.policy_code LEFT JOIN ent_info USING (ent_id)
WHERE (user_id NOT IN ('9999') OR user_id IS NULL) AND insure_code IS NOT NULL
UNION ALL
SELECT p.policy_id, NULL, NULL, p.policy_code, insure_code, NULL, CASE WHEN status = '1' AND cast(end_date AS date) >= DATE '{AS_OF}' THEN '1' ELSE '0' END, NULL,
  holder_name, office_province, product_name, cast(pl.a AS varchar), pl.t, CASE pl.i WHEN 0.05 THEN '1' WHEN 0.1 THEN '2' END, cast(pl.y AS varchar), ent_id, ent_name, NULL, '2.0'
FROM v2_policy p LEFT JOIN (SELECT policy_no, r.a AS a, r.t AS t, r.i AS i, r.y AS y FROM (SELECT policy_no, min(struct_pack(a := plan_amount, t := contain_trainee,
    i := injure_percent, y := payment_type)) AS r FROM v2_plan GROUP BY 1)) pl USING (policy_no)
LEFT JOIN product ON product_code = insure_code LEFT JOIN v2_holder USING (policy_no) LEFT JOIN ent_map m ON m.policy_code = p.policy_code LEFT JOIN ent_info USING (ent_id)""")(
    lambda v: MG.merge_policy(
        MG.policy_v1(v.v1_order, v.v1_policy.drop("user_id"), v.v1_first_premium, v.product,
                     v.sku_term.withColumnRenamed("sku_code", "sku_id").withColumn("sku_code", F.col("sku_id")), v.v1_holder, v.ent_map, v.ent_info, RULES),
        MG.policy_v2(v.v2_policy, v.v2_plan, v.product, v.v2_holder, v.ent_map, v.ent_info, AS_OF),
    ).select(*_PK)
)

# ---------------------------------------------------------- reconciliation

for _name, _keys in (("policy", ["policy_no"]), ("batch", ["batch_no"]), ("both", ["policy_no", "batch_no"])):
    _k = ", ".join(_keys)
    _cols = ", ".join(
        f"CASE WHEN hit IS NULL THEN '无' ELSE {c} END AS {c}" if c in _keys else c for c in ("policy_no", "batch_no")
    )
    query("recon_match" if _name == "both" else f"recon_match_{_name}", f"""
SELECT {_cols}, cast(premium AS double) AS premium, cast(settlement AS double) AS settlement, cast(sp AS double) AS small_premium,
  cast(ss AS double) AS small_settlement, CASE WHEN hit IS NULL THEN '匹配失败' ELSE '匹配成功' END AS machine
FROM ledger_big LEFT JOIN (SELECT {_k}, sum(premium) AS sp, sum(settlement) AS ss, 1 AS hit FROM ledger_small GROUP BY ALL) USING ({_k})""")(
        lambda v, k=_keys: (lambda m: m.select(
            *[F.col(c).cast("double").alias(c) if c in ("premium", "settlement", "small_premium", "small_settlement") else c for c in m.columns]
        ))(R.recon_match(v.ledger_big, v.ledger_small, k))
    )
query("recon_unmatched", """
SELECT policy_no, batch_no, cast(premium AS double) AS premium FROM ledger_small s
WHERE NOT EXISTS (SELECT 1 FROM ledger_big b WHERE b.policy_no = s.policy_no AND b.batch_no = s.batch_no)""")(
    lambda v: R.recon_unmatched(v.ledger_small, v.ledger_big, ["policy_no", "batch_no"]).select("policy_no", "batch_no", F.col("premium").cast("double").alias("premium"))
)

# ----------------------------------------------------------- web and CRM

query("web_time_shift", """
SELECT hex(encode(cast(idvisitor AS varchar))) AS idvisitor, idlink, strftime(server_time + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS server_time,
  strftime(server_time + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS server_text, strftime(server_time + INTERVAL 8 HOUR, '%H:%M:%S') AS clock, idaction_url
FROM web_link""")(
    lambda v: W.shift_times(v.web_link.select(
        F.encode(F.col("idvisitor").cast("string"), "utf-8").alias("idvisitor"), "idlink", "server_time",
        F.date_format("server_time", "yyyy-MM-dd HH:mm:ss").alias("server_text"), F.date_format("server_time", "HH:mm:ss").alias("clock"),
        "idaction_url", F.lit("x").alias("custom_var_1"),
    )).withColumn("server_time", F.date_format("server_time", "yyyy-MM-dd HH:mm:ss"))
)
query("web_action_names", """
SELECT idlink, idvisit, idaction_url, idaction_name, coalesce(u.name, '0') AS idaction_url_name, coalesce(n.name, '0') AS idaction_name_vt,
  visit_total_actions FROM web_link JOIN web_visit USING (idvisit) LEFT JOIN web_action u ON idaction_url = u.idaction
LEFT JOIN web_action n ON idaction_name = n.idaction""")(
    lambda v: W.web_actions(v.web_link, v.web_visit, v.web_action).select(
        "idlink", "idvisit", "idaction_url", "idaction_name", "idaction_url_name", "idaction_name_vt", "visit_total_actions")
)
_FIELDS = {"channel": "channel", "source": "source", "detail": "detail"}
_CRM = """
SELECT DISTINCT customer_id, name, a.value AS channel_label, b.value AS source_label, d.value AS detail_label, level, update_time, sale_process, ent_name
FROM customers_crm LEFT JOIN options_crm a ON a.field = 'channel' AND a.key = channel LEFT JOIN options_crm b ON b.field = 'source' AND b.key = source
LEFT JOIN options_crm d ON d.field = 'detail' AND d.key = detail LEFT JOIN business_crm USING (customer_id)"""


def _mart(v):
    return W.crm_mart(v.customers_crm, v.options_crm, v.business_crm, _FIELDS)


query("code_to_label", f"SELECT * REPLACE (cast(update_time AS varchar) AS update_time) FROM ({_CRM})")(
    lambda v: _mart(v).select("customer_id", "name", "channel_label", "source_label", "detail_label", "level",
                              F.col("update_time").cast("string").alias("update_time"), "sale_process", "ent_name")
)
query("latest_per_key", f"""
WITH m AS (SELECT trim(coalesce(ent_name, name)) AS name, channel_label, level, update_time FROM ({_CRM})),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY update_time DESC, channel_label DESC NULLS LAST, level DESC) AS k FROM m)
SELECT name, channel_label, level, cast(update_time AS varchar) AS update_time FROM r WHERE k = 1""")(
    lambda v: W.latest_channel(_mart(v)).withColumn("update_time", F.col("update_time").cast("string"))
)
query("earliest_per_key", """
WITH r AS (SELECT ent_id, policy_id, policy_create_time, row_number() OVER (PARTITION BY ent_id ORDER BY policy_create_time, policy_id) AS k FROM policy)
SELECT ent_id, cast(policy_create_time AS varchar) AS policy_create_time, policy_id FROM r WHERE k = 1""")(
    lambda v: FA.earliest_per_key(v.policy.select("ent_id", "policy_create_time", "policy_id"), "ent_id", "policy_create_time").withColumn(
        "policy_create_time", F.col("policy_create_time").cast("string"))
)
query("plan_matrix", f"""
WITH {PDAY},
snap AS (SELECT policy_id, (SELECT count(DISTINCT insured_cert_no) FROM insured_term t WHERE t.policy_id = p.policy_id
    AND DATE '{AS_OF}' BETWEEN insured_start_date AND insured_end_date) AS curr FROM policy p WHERE DATE '{AS_OF}' BETWEEN start_date AND end_date
  AND insure_code IN (SELECT product_code FROM product WHERE dim_1 IN ({SCOPE}))),
due AS (SELECT policy_no, sum(CASE WHEN regexp_matches(coalesce(final_payment, pre_com), '[一-龥]') THEN NULL
  ELSE try_cast(nullif(coalesce(final_payment, pre_com), '') AS decimal(20,4)) END) AS due FROM claims GROUP BY 1),
ern AS (SELECT policy_id, sum(price) AS earned FROM pday WHERE day_id <= '{TODAY}' GROUP BY 1),
ppl AS (SELECT policy_id, count(DISTINCT insured_cert_no) AS persons FROM insured GROUP BY 1),
r AS (SELECT ch.channel, profession_type, sku_coverage, ch.salesman, coalesce(team_name, '公司') AS team_name, ch.biz_operator, a.short_name AS province,
  CASE WHEN a.short_name IN ('北京市', '天津市', '上海市', '重庆市') THEN a.short_name ELSE b.short_name END AS city, curr, due, earned, coalesce(persons, 0) AS persons,
  cast(CASE sku_charge_type WHEN '2' THEN cast(sku_price AS double) / 12 ELSE sku_price END AS decimal(13,4)) AS price
  FROM snap JOIN policy p USING (policy_id) JOIN channel ch ON ch.ent_name = trim(holder_company) LEFT JOIN team ON sale_name = ch.salesman
  LEFT JOIN policy_place pp ON pp.policy_code = p.policy_code LEFT JOIN place_names a ON a.code = pp.office_province LEFT JOIN place_names b ON b.code = pp.office_city
  LEFT JOIN due ON policy_no = p.policy_code LEFT JOIN ern USING (policy_id) LEFT JOIN work_grade g ON g.policy_code = p.policy_code LEFT JOIN ppl USING (policy_id)
  WHERE policy_status IN ('0','1'))
SELECT channel, profession_type, sku_coverage, min(salesman) AS salesman, min(team_name) AS team_name, min(biz_operator) AS biz_operator, min(province) AS province,
  min(city) AS city, cast(sum(curr) AS bigint) AS curr_insured, cast(sum(coalesce(due, 0)) AS double) AS pre_com, cast(sum(coalesce(earned, 0)) AS double) AS charged_premium,
  cast(sum(persons) AS bigint) AS insured_count, cast(sum(price * persons) AS double) AS all_premium,
  round(cast(sum(price * persons) AS double) / nullif(sum(persons), 0), 4) AS avg_premium, substr(channel, 1, 5) AS short_name FROM r GROUP BY 1, 2, 3""")(
    lambda v: mart.plan_matrix(
        ST.policy_standing(v.policy, v.insured_term, AS_OF, scope(v)), v.policy, None, v.policy.select("policy_code", "sku_coverage", "sku_price", "sku_charge_type"),
        v.product, v.channel, v.team, v.policy_place, v.place_names, v.claims, None, v.work_grade, AS_OF)
)

# ---------------------------------------------------------- product flags


def _ride_facts(v):
    return v.rides.select("insured_name", "insured_cert_no", F.lit("").alias("insured_mobile"), F.lit("ofo").alias("product_type"))


def _facts(v):
    return FA.union_facts(v.facts, _ride_facts(v))


_U = "SELECT insured_name, insured_cert_no, insured_mobile, product_type FROM facts UNION SELECT insured_name, insured_cert_no, NULL, 'ofo' FROM rides"
query("union_sources", _U)(_facts)
_FL = ", ".join(f"coalesce(max(CASE WHEN product_type = '{k}' THEN 1 ELSE 0 END), 0) AS {f}" for k, f in FA.FLAGS.items())
_CO = ", ".join(f"coalesce({f}, 0) AS {f}" for f in FA.FLAGS.values())
_OUT = f"SELECT insured_name, insured_cert_no, insured_mobile, {_CO} FROM (SELECT DISTINCT insured_name, insured_cert_no, insured_mobile FROM u) p"
query("product_flags", f"WITH u AS ({_U}) SELECT insured_cert_no, {_FL} FROM u GROUP BY 1")(
    lambda v: FA.flags_per(_facts(v), "insured_cert_no")
)
query("product_flags_by_id", f"WITH u AS ({_U}), f AS (SELECT insured_cert_no, {_FL} FROM u GROUP BY 1) {_OUT} LEFT JOIN f USING (insured_cert_no)")(
    lambda v: FA.product_flags_by_id(_facts(v))
)
query("product_flags_by_mobile", f"""
WITH u AS ({_U}), f AS (SELECT insured_mobile, {_FL} FROM u WHERE insured_mobile IS NOT NULL GROUP BY 1 HAVING count(DISTINCT insured_cert_no) <= 1)
{_OUT} LEFT JOIN f USING (insured_mobile)""")(lambda v: FA.product_flags_by_mobile(_facts(v)))


def _people(v):
    return v.insured.select("insured_name", "insured_mobile", "insured_cert_no", S.id_gender("insured_cert_no").alias("gender"),
                            S.id_birth_year("insured_cert_no").alias("age"))


query("mobile_enrich", """
WITH p AS (SELECT insured_mobile, insured_cert_no, CASE cast(substr(insured_cert_no, 17, 1) AS int) % 2 WHEN 1 THEN '男' ELSE '女' END AS gender,
  cast(substr(insured_cert_no, 7, 4) AS int) AS age, CASE WHEN count(DISTINCT insured_name) = 1 THEN min(insured_name) ELSE '' END AS insured_name FROM insured GROUP BY 1, 2, 3, 4)
SELECT DISTINCT p.*, province, city, operator FROM p LEFT JOIN mobile_place ON mobile = insured_mobile""")(
    lambda v: FA.mobile_enrich(_people(v), v.mobile_place)
)
query("mobile_unmatched", "SELECT DISTINCT insured_mobile FROM insured WHERE insured_mobile NOT IN (SELECT mobile FROM mobile_place)")(
    lambda v: FA.unmatched_mobiles(FA.mobile_enrich(_people(v), v.mobile_place))
)
query("dedup_first", """
WITH r AS (SELECT insured_mobile, insured_cert_no, insured_name, row_number() OVER (PARTITION BY insured_mobile ORDER BY insured_cert_no, insured_name) AS k FROM insured)
SELECT insured_mobile, insured_cert_no, insured_name FROM r WHERE k = 1""")(
    lambda v: FA.dedup_first(v.insured.select("insured_mobile", "insured_cert_no", "insured_name"), "insured_mobile", ["insured_cert_no"])
)


def _shards(v):
    """Order tables by year as shards in folders of their own, with different column orders; the years come from the data."""
    path = session.scratch(v.spark, "shards")
    o = v.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("string").alias("shard"))
    o.write.partitionBy("shard").parquet(path)
    names = sorted(r.shard for r in o.select("shard").distinct().collect())  # as many as there are databases
    shards = [v.spark.read.parquet(f"{path}/shard={n}").withColumn("shard", F.lit(n)) for n in names]
    return [s.select("shard", "o_custkey", "o_orderkey") if i % 2 else s for i, s in enumerate(shards)]


query("union_monthly_shards", "SELECT o_orderkey, o_custkey, cast(year(o_orderdate) AS varchar) AS shard FROM orders")(
    lambda v: FA.union_shards(*_shards(v))
)

# --------------------------------------------------------------- profiles

_OK = "length({c}) = 18 AND regexp_matches({c}, '^[0-9]{{17}}') AND substr({c}, 7, 2) IN ('19', '20')"
_MONTHS = """(year({b}) - year({a})) * 12 + month({b}) - month({a}) - CASE WHEN day({b}) >= least(day({a}), day(last_day({b}))) THEN 0 ELSE 1 END"""
query("profile_person", f"""
WITH s AS (SELECT DISTINCT * FROM people_sources WHERE {_OK.format(c='cert')}),
n AS (SELECT *, row_number() OVER (PARTITION BY cert ORDER BY create_time DESC, end_time DESC, identity DESC, product_code DESC, customer_name DESC, insured_name DESC) AS k FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY cert ORDER BY create_time, end_time, identity, product_code, customer_name, insured_name) AS k FROM s),
c AS (SELECT cert, string_agg(DISTINCT product_code, '|' ORDER BY product_code) AS user_insure_code, count(*) AS user_insure_product_num FROM s GROUP BY 1)
SELECT cert, CASE cast(substr(cert, 17, 1) AS int) % 2 WHEN 1 THEN '男' ELSE '女' END AS gender, {AS_OF[:4]} - cast(substr(cert, 7, 4) AS int) AS age,
  coalesce(nullif(n.insured_name, ''), 'null') AS insured_name, substr(n.create_time, 1, 10) AS end_data, substr(n.end_time, 1, 10) AS b_x_date,
  coalesce(nullif(n.identity, ''), 'null') AS social_identity, {_MONTHS.format(a="cast(substr(o.create_time, 1, 10) AS date)", b=f"DATE '{AS_OF}'")} AS insure_to_month,
  o.product_code AS insurance_products, o.customer_name AS customer_source, substr(o.create_time, 1, 10) AS start_date, user_insure_code, user_insure_product_num
FROM n JOIN o USING (cert) JOIN c USING (cert) WHERE n.k = 1 AND o.k = 1""")(lambda v: PF.profile_person(v.people_sources, AS_OF))
_HOUR = "hour(start_date)"
query("ride_behaviour", f"""
WITH r AS (SELECT *, {_HOUR} >= 22 OR {_HOUR} <= 3 AS owl, {_HOUR} BETWEEN 4 AND 7 AS early, isodow(start_date) AS wd,
  isodow(start_date) <= 5 AND {_HOUR} BETWEEN 6 AND 9 AS com, cast(start_date AS date) BETWEEN DATE '{EVENT_AS_OF}' - INTERVAL 3 MONTH AND DATE '{EVENT_AS_OF}' AS rec
  FROM rides WHERE {_OK.format(c='insured_cert_no')}),
w AS (SELECT insured_cert_no, wd, row_number() OVER (PARTITION BY insured_cert_no ORDER BY count(*) DESC, wd) AS k FROM r GROUP BY 1, 2),
g AS (SELECT insured_cert_no, count(*) AS n, count(*) FILTER (owl) AS o, count(*) FILTER (early) AS e, count(*) FILTER (com) AS c, count(*) FILTER (rec) AS t,
  max(start_date) AS hi, min(start_date) AS lo, max_by(end_date, start_date) AS hie, min_by(coalesce(nullif(product_code, ''), 'null'), start_date) AS p FROM r GROUP BY 1)
SELECT insured_cert_no, CASE WHEN o > e AND o >= 10 THEN '夜猫子' WHEN e > o AND e >= 10 THEN '早起族' ELSE 'null' END AS early_night,
  CASE WHEN c >= 3 THEN '上班族' ELSE 'null' END AS work, cast(wd AS varchar) AS weeks, CASE WHEN t = n THEN cast(90 // n AS varchar) ELSE 'null' END AS frequency,
  strftime(hi, '%Y-%m-%d %H:%M:%S') AS end_data, strftime(hie, '%Y-%m-%d %H:%M:%S') AS b_x_date, strftime(lo, '%Y-%m-%d %H:%M:%S') AS start_date,
  {_MONTHS.format(a="cast(lo AS date)", b=f"DATE '{EVENT_AS_OF}'")} AS insure_to_month, n AS user_insure_product_num, p AS insurance_products,
  CASE p WHEN 'OFO00001' THEN '校园版' WHEN 'OFO00002' THEN '城市版' ELSE 'null' END AS user_type,
  CASE p WHEN 'OFO00001' THEN '30' WHEN 'OFO00002' THEN '50' ELSE 'null' END AS guarantee FROM g JOIN w USING (insured_cert_no) WHERE k = 1""")(
    lambda v: PF.ride_behaviour(PF.ride_facts(v.rides, EVENT_AS_OF), EVENT_AS_OF)
)
query("ride_edition", """
SELECT insured_cert_no, count(*) FILTER (product_code = 'OFO00001') AS campus_rides, count(*) FILTER (product_code = 'OFO00002') AS city_rides
FROM rides GROUP BY 1""")(lambda v: PF.ride_editions(v.rides))
_KIND = [("snow", "skiing", "user_skiing"), ("swim", "swimming", "user_swimming"), ("race", "race", "user_competition"), ("marathon", "marathon", "user_marathon")]
query("sport_category", """
WITH k AS (SELECT product_code, unnest(list_filter([CASE WHEN product_name LIKE '%snow%' THEN 'user_skiing' END, CASE WHEN product_name LIKE '%swim%' THEN 'user_swimming' END,
    CASE WHEN product_name LIKE '%race%' THEN 'user_competition' END, CASE WHEN product_name LIKE '%marathon%' THEN 'user_marathon' END], lambda x: x IS NOT NULL)) AS label
  FROM product WHERE product_type_1 = '体育')
SELECT insured_cert_no, label, CASE label WHEN 'user_skiing' THEN 'skiing' WHEN 'user_swimming' THEN 'swimming' WHEN 'user_competition' THEN 'race' ELSE 'marathon' END AS sport,
  cast(max(policy_create_time) AS varchar) AS latest FROM insured JOIN policy USING (policy_id) JOIN k ON insure_code = product_code
WHERE policy_status IN ('0','1','7','9','10') GROUP BY 1, 2""")(
    lambda v: PF.sport_category(
        v.policy, v.insured.join(v.policy.select("policy_id", F.col("policy_create_time").alias("insured_create_time")), "policy_id"), v.product, _KIND
    ).withColumn("latest", F.col("latest").cast("string"))
)
query("id_card_features", f"""
SELECT DISTINCT insured_cert_no, CASE cast(substr(insured_cert_no, 17, 1) AS int) % 2 WHEN 1 THEN '男' ELSE '女' END AS gender,
  cast(substr(insured_cert_no, 7, 4) AS int) AS birth_year, {AS_OF[:4]} - cast(substr(insured_cert_no, 7, 4) AS int) AS age,
  concat(substr(insured_cert_no, 1, 2), '0000') AS province_code, concat(substr(insured_cert_no, 1, 4), '00') AS city_code,
  substr(insured_cert_no, 1, 6) AS county_code, substr(insured_cert_no, 11, 4) AS constellation_key
FROM insured WHERE {_OK.format(c='insured_cert_no')}""")(lambda v: PF.id_card_features(v.insured, AS_OF))
query("id_card_regions", """
SELECT DISTINCT insured_cert_no, coalesce(p.n_name, '0') AS province, coalesce(c.n_name, '0') AS city, coalesce(r_name, '0') AS grade
FROM insured LEFT JOIN nation p ON concat(cast(10 + p.n_nationkey AS varchar), '0000') = concat(substr(insured_cert_no, 1, 2), '0000') AND p.n_regionkey <> 2
LEFT JOIN nation c ON concat(cast(10 + c.n_nationkey AS varchar), '0100') = concat(substr(insured_cert_no, 1, 4), '00') AND c.n_regionkey <> 2
LEFT JOIN nation g ON concat(cast(10 + g.n_nationkey AS varchar), '0100') = concat(substr(insured_cert_no, 1, 4), '00') LEFT JOIN region ON g.n_regionkey = r_regionkey""")(
    lambda v: PF.with_regions(
        PF.id_card_features(v.insured, AS_OF),
        v.sql("""SELECT concat(cast(10 + n_nationkey AS string), '0000') AS code, n_name AS name FROM nation WHERE n_regionkey <> 2
UNION ALL SELECT concat(cast(10 + n_nationkey AS string), '0100'), n_name FROM nation WHERE n_regionkey <> 2"""),
        v.sql("SELECT concat(cast(10 + n_nationkey AS string), '0100') AS code, r_name AS grade FROM nation JOIN region ON n_regionkey = r_regionkey"),
        v.sql("SELECT * FROM (VALUES ('0101', 'goat'), ('0201', 'waterman')) AS t(key, name)"),
    ).select("insured_cert_no", "province", "city", "grade")
)
