"""Channel roll-ups, person labels and the label store tables."""

from pyspark.sql import functions as F

from .. import session
from ..operators import base as B
from ..operators import channel as CH
from ..operators import claim as C
from ..operators import enterprise as E
from ..operators import person as P
from ..sources import sinks
from .catalog import query
from .q_enterprise import DUE, OWN, STREAK_SQL, VALID
from .views import AS_OF


def label_rows(v):
    """Long label rows of three families from the fused label tables."""
    claim = CH.triples(C.claim_labels(v.claims, v.policy), "ent_id", "claiminfo", ["report_num", "death_num", "all_compensation"])
    totals = E.policy_totals(v.policy).select("ent_id", "effective_policy", F.col("total_premium").cast("double").alias("total_premium"))
    insure = CH.triples(totals, "ent_id", "insureinfo")
    base = CH.triples(v.sum_level, "ent_id", "baseinfo", ["ent_scale", "ent_influence_level"])
    return claim.unionByName(insure).unionByName(base)


LABEL_ROWS = f"""
SELECT ent_id AS entity_id, 'claiminfo' AS family, 'report_num' AS label, cast(count(*) AS varchar) AS value,
  cast(count(*) AS double) AS num {OWN} GROUP BY 1
UNION ALL SELECT ent_id, 'claiminfo', 'death_num', cast(count(*) AS varchar), cast(count(*) AS double) {OWN} AND case_type = '死亡' GROUP BY 1
UNION ALL SELECT ent_id, 'claiminfo', 'all_compensation', NULL, cast(sum(cast(final_payment AS decimal(20,4))) AS double)
  {OWN} AND length(final_payment) > 0 GROUP BY 1
UNION ALL SELECT ent_id, 'insureinfo', 'effective_policy', cast(count(*) AS varchar), cast(count(*) AS double) FROM policy WHERE {VALID} GROUP BY 1
UNION ALL SELECT ent_id, 'insureinfo', 'total_premium', NULL, cast(sum(premium) AS double) FROM policy WHERE {VALID} GROUP BY 1
UNION ALL SELECT ent_id, 'baseinfo', 'ent_scale', ent_scale, cast(ent_scale AS double) FROM sum_level
UNION ALL SELECT ent_id, 'baseinfo', 'ent_influence_level', ent_influence_level, NULL FROM sum_level"""



def label_store(v):
    """The label rows written to a store, the way the label jobs leave them."""
    path = session.scratch(v.spark, "label-store")
    sinks.write_labels(label_rows(v), path)
    return path


query("label_scan", f"SELECT entity_id, family, label, num FROM ({LABEL_ROWS})")(
    lambda v: sinks.read_labels(v.spark, label_store(v)).select("entity_id", "family", "label", "num")
)
query("label_pruned", f"SELECT entity_id, label, num FROM ({LABEL_ROWS}) WHERE family = 'claiminfo' AND label IN ('report_num', 'death_num')")(
    lambda v: sinks.read_labels(v.spark, label_store(v), "claiminfo", ["report_num", "death_num"]).select("entity_id", "label", "num")
)
query("label_wide", f"""
SELECT entity_id, coalesce(max(num) FILTER (label = 'report_num'), 0) AS report_num,
  coalesce(max(num) FILTER (label = 'effective_policy'), 0) AS effective_policy,
  coalesce(max(num) FILTER (label = 'total_premium'), 0) AS total_premium,
  coalesce(max(value) FILTER (label = 'ent_influence_level'), '') AS ent_influence_level
FROM ({LABEL_ROWS}) WHERE label IN ('report_num', 'effective_policy', 'total_premium', 'ent_influence_level') GROUP BY 1""")(
    lambda v: sinks.wide(
        sinks.read_labels(v.spark, label_store(v)), ["report_num", "effective_policy", "total_premium", "ent_influence_level"],
        {"report_num": 0, "effective_policy": 0, "total_premium": 0},
    ).withColumn("ent_influence_level", F.coalesce("ent_influence_level", F.lit("")))
)

_MAP = "SELECT DISTINCT ent_id, trim(ent_name) AS ent_name, CASE WHEN channel_name = '直客' THEN trim(ent_name) ELSE trim(channel_name) END AS ch FROM channel"
query("channel_sum", f"""
WITH m AS ({_MAP}), l AS ({LABEL_ROWS})
SELECT ch AS channel, label, cast(sum(cast(num AS decimal(24,4))) AS double) AS num FROM l JOIN m ON entity_id = ent_id
WHERE label IN ('report_num', 'death_num', 'effective_policy', 'ent_scale', 'total_premium') GROUP BY 1, 2""")(
    lambda v: CH.roll_sum(
        label_rows(v).where(F.col("label").isin("report_num", "death_num", "effective_policy", "ent_scale", "total_premium"))
        .withColumn("num", F.col("num").cast("decimal(24,4)")),
        CH.channel_map(v.channel),
    ).withColumn("num", F.col("num").cast("double"))
)
query("channel_max", f"""
WITH m AS ({_MAP}), l AS (SELECT ent_id, greatest(1, floor(date_diff('day', min(policy_create_time), DATE '{AS_OF}') / 30)) AS num
  FROM policy WHERE {VALID} GROUP BY 1)
SELECT ch AS channel, 'ent_fist_plc_month' AS label, cast(max(num) AS double) AS num FROM l JOIN m USING (ent_id) GROUP BY 1""")(
    lambda v: CH.roll_max(CH.triples(E.months_since_first(v.policy, AS_OF), "ent_id", "insureinfo"), CH.channel_map(v.channel))
)
_LIVE = "SELECT ent_id, month_id FROM summary_month WHERE data_type = 'totalInsuredPersons' AND cast(data_val AS bigint) > 0"
query("channel_months", f"""
WITH m AS ({_MAP}), d AS (SELECT DISTINCT ch, month_id FROM ({_LIVE}) JOIN m USING (ent_id))
SELECT ch AS channel, 'ent_continuous_plc_month' AS label, string_agg(month_id, '-' ORDER BY month_id) AS value FROM d GROUP BY 1""")(
    lambda v: CH.roll_set(
        CH.triples(E.month_summary_labels(v.summary_month, "totalInsuredPersons"), "ent_id", "insureinfo", ["ent_continuous_plc_month"]),
        CH.channel_map(v.channel), "-")
)
query("channel_products", f"""
WITH m AS ({_MAP}), d AS (SELECT DISTINCT ch, insure_code FROM policy JOIN m USING (ent_id) WHERE policy_status IN ('0','1','7','9','10'))
SELECT ch AS channel, 'ent_insure_code' AS label, string_agg(insure_code, '|' ORDER BY insure_code) AS value FROM d GROUP BY 1""")(
    lambda v: CH.roll_set(CH.triples(B.product_set(v.policy), "ent_id", "baseinfo"), CH.channel_map(v.channel), "|")
)
query("channel_best", f"""
WITH m AS ({_MAP}), c AS (SELECT ent_id, work_type, count(*) AS n FROM policy JOIN insured USING (policy_id)
  JOIN work_level ON insured_work_type = work_type WHERE insure_policy_status = '1' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY ent_id ORDER BY n DESC, work_type) AS k FROM c),
b AS (SELECT ch, n, concat(work_type, '|', n) AS value FROM r JOIN m USING (ent_id) WHERE k = 1),
q AS (SELECT *, row_number() OVER (PARTITION BY ch ORDER BY n DESC, value) AS j FROM b)
SELECT ch AS channel, 'ent_first_craft' AS label, value FROM q WHERE j = 1""")(
    lambda v: CH.roll_best(CH.triples(E.job_type_nth(v.policy, v.insured, v.work_level, 1), "ent_id", "insureinfo"), CH.channel_map(v.channel))
)
query("channel_members", f"""
WITH m AS ({_MAP}) SELECT entity_id, family, label, num FROM ({LABEL_ROWS})
WHERE entity_id IN (SELECT ent_id FROM m WHERE ch = 'NATION_7')""")(
    lambda v: CH.members(label_rows(v), CH.channel_map(v.channel), "NATION_7").select("entity_id", "family", "label", "num")
)
_DATE = "try_strptime({}, '%Y/%m/%d')"
query("channel_ratio", f"""
WITH m AS ({_MAP}),
prem AS (SELECT ent_id, sum(premium) AS p FROM policy WHERE {VALID} GROUP BY 1),
mon AS (SELECT ent_id, count(*) AS months, sum(cast(data_val AS bigint)) AS mp FROM summary_month WHERE data_type = 'totalInsuredPersons' GROUP BY 1),
reg AS (SELECT ent_id, count(DISTINCT preserve_id) AS r FROM policy JOIN endorse USING (policy_id) WHERE preserve_status IN ('4','5') GROUP BY 1),
act AS (SELECT ent_id, count(DISTINCT insured_cert_no) FILTER (insure_policy_status = '1') AS a, count(*) AS times,
  count(DISTINCT insured_cert_no) AS persons FROM policy JOIN insured USING (policy_id) WHERE {VALID} GROUP BY 1),
sz AS (SELECT ent_id, max(cast(ent_scale AS int)) AS scale FROM sum_level GROUP BY 1),
sex AS (SELECT ent_id, count(*) AS gn, sum(cast(substr(insured_cert_no, 17, 1) AS int) % 2) AS men FROM policy JOIN insured USING (policy_id) GROUP BY 1),
age AS (SELECT ent_id, count(*) AS an, sum(year(insured_start_date) - year(insured_birthday) - CASE WHEN
  month(insured_start_date) * 100 + day(insured_start_date) < month(insured_birthday) * 100 + day(insured_birthday) THEN 1 ELSE 0 END) AS yrs
  FROM policy JOIN insured_term USING (policy_id) GROUP BY 1),
cl AS (SELECT ent_id, count(*) AS c, count(*) FILTER (if_resubmit_paper = '是') AS res,
  count(*) FILTER (case_type = '死亡') AS dea, count(*) FILTER (case_type = '残疾') AS dis,
  sum(greatest(abs(date_diff('day', {_DATE.format('risk_date')}, {_DATE.format('report_date')})), 1))
    FILTER ({_DATE.format('report_date')} IS NOT NULL) AS dd, count(*) FILTER ({_DATE.format('report_date')} IS NOT NULL) AS dn,
  sum(abs(date_diff('day', {_DATE.format('risk_date')}, {_DATE.format('paper_finish_date')}))) AS ad, count(paper_finish_date) AS an2,
  sum(CASE WHEN regexp_matches(finish_days, '[一-龥]') THEN 0 ELSE try_cast(finish_days AS bigint) END) FILTER (finish_days NOT LIKE '%=%') AS sd,
  count(*) FILTER (finish_days NOT LIKE '%=%') AS sn {OWN} GROUP BY 1),
rk AS (SELECT ent_id, sum(risk_period) AS rd, count(*) AS rn, count(*) FILTER (risk_period < 3) AS rs
  FROM policy JOIN risk_period ON policy_code = policy_no GROUP BY 1),
f AS (SELECT ch, cast(sum(p) AS double) AS p, sum(months) AS months, sum(mp) AS mp, sum(r) AS r, sum(a) AS a, sum(times) AS times, sum(persons) AS persons,
  sum(scale) AS scale, sum(gn) AS gn, sum(men) AS men, sum(an) AS an, sum(yrs) AS yrs, sum(c) AS c, sum(res) AS res, sum(dea) AS dea,
  sum(dis) AS dis, sum(dd) AS dd, sum(dn) AS dn, sum(ad) AS ad, sum(an2) AS an2, sum(sd) AS sd, sum(sn) AS sn, sum(rd) AS rd, sum(rn) AS rn, sum(rs) AS rs
  FROM m LEFT JOIN prem USING (ent_id) LEFT JOIN mon USING (ent_id) LEFT JOIN reg USING (ent_id) LEFT JOIN act USING (ent_id)
  LEFT JOIN sz USING (ent_id) LEFT JOIN sex USING (ent_id) LEFT JOIN age USING (ent_id) LEFT JOIN cl USING (ent_id) LEFT JOIN rk USING (ent_id) GROUP BY 1)
SELECT ch AS channel, p / months AS avg_month_premium, p / months * 12 AS avg_year_premium, p / nullif(persons, 0) AS avg_person_premium,
  round(a / nullif(scale, 0) * 100, 2) AS insured_rate, cast(floor(mp / months) AS bigint) AS ent_month_plc_persons,
  cast(ceil(r / months) AS bigint) AS ent_month_regulation_times, round(yrs / an, 4) AS ent_employee_age, round(men / gn * 100, 2) AS men_share,
  round(c * 100 / times, 4) AS ent_monthly_risk, round(1 - res / c, 4) AS ent_material_integrity, round(sd / sn, 4) AS avg_aging_cps,
  round(dd / dn, 4) AS ent_report_time, round(ad / an2, 4) AS avg_aging_claim, round(rd / rn, 4) AS avg_aging_risk,
  CASE WHEN rs > 1 THEN round(rs / rn, 4) END AS mix_period_rate,
  CASE WHEN dea > 0 AND dis > 0 THEN round((dea + dis) / c, 4) END AS largecase_rate FROM f""")(
    lambda v: CH.channel_ratios(
        CH.channel_facts(CH.channel_map(v.channel), v.policy, v.insured_detail, v.endorse, v.summary_month, v.sum_level, v.claims)
    )
)
query("channel_profile", f"""
WITH m AS ({_MAP}) SELECT DISTINCT ch AS channel, certificate AS ent_type, split_part(first_insure_time, ' ', 1) AS first_insure_time,
  p.name AS ent_province, p.short_name AS ent_city, city_grade AS ent_city_type
FROM m JOIN enterprise e ON ch = e.ent_name LEFT JOIN cant p ON office_province = p.code LEFT JOIN city_grade ON office_city = city_code
LEFT JOIN certificate ON triangle_status = id_nub AND length(certificate) > 0""")(
    lambda v: CH.channel_profile(B.ent_profile(v.enterprise, v.cant, v.city_grade, v.certificate, v.sum_level), CH.channel_map(v.channel))
)
query("channel_streak", STREAK_SQL.format(
    key="channel", out="streak",
    months=f"SELECT ch AS channel, month_id FROM ({_LIVE}) JOIN ({_MAP}) USING (ent_id)"))(
    lambda v: CH.channel_streak(v.summary_month, CH.channel_map(v.channel)).select("channel", "streak")
)

# ----------------------------------------------------------------- persons

query("person_any", """
SELECT insured_cert_no, min(insured_company_name) AS user_company, min(ai_level) AS user_craft_level, min(ent_id) AS user_ent_id
FROM insured LEFT JOIN work_level ON insured_work_type = work_type LEFT JOIN policy USING (policy_id) GROUP BY 1""")(
    lambda v: P.person_any(v.policy, v.insured, v.work_level)
)
query("person_has_child", "SELECT DISTINCT insured_cert_no, '是' AS user_child FROM insured WHERE length(child_cert_no) > 4")(
    lambda v: P.person_has_child(v.insured)
)
query("person_claims", """
SELECT cert_no, count(*) AS user_report_num, count(*) FILTER (length(paper_finish_date) > 0) AS claim_count,
  count(*) FILTER (case_type = '死亡') AS death_count, count(*) FILTER (case_type = '残疾') AS disable_count,
  count(*) FILTER (scene = '工作期间') AS worktime_count, count(*) FILTER (scene IN ('非工作期间', '上下班')) AS nonworktime_count,
  count(*) FILTER (overtime = '是') AS overtime_count FROM claims GROUP BY 1""")(lambda v: P.person_claims(v.claims))
query("person_short_risk", "SELECT cert_no, count(*) AS user_aging_risk FROM risk_period WHERE risk_period < 3 GROUP BY 1")(
    lambda v: P.person_short_risk(v.risk_period)
)
query("person_coverage", """
SELECT insured_cert_no, max(cast(sku_coverage AS bigint)) AS official_website_coverage FROM insured JOIN policy USING (policy_id) GROUP BY 1""")(
    lambda v: P.person_coverage(v.policy, v.insured)
)
query("person_coverage_rides", """
SELECT insured_cert_no, max(c) AS user_insure_coverage FROM (
  SELECT insured_cert_no, cast(sku_coverage AS bigint) AS c FROM insured JOIN policy USING (policy_id)
  UNION ALL SELECT insured_cert_no, CASE product_code WHEN 'OFO00001' THEN 30 WHEN 'OFO00002' THEN 50 END FROM rides)
WHERE c IS NOT NULL GROUP BY 1""")(lambda v: P.coverage_with_rides(v.policy, v.insured, v.rides))
query("person_policy_count", """
SELECT insured_cert_no, count(*) AS policy_count FROM insured JOIN policy USING (policy_id)
WHERE policy_status IN ('0','1','7','9','10') GROUP BY 1""")(lambda v: P.person_policy_count(v.policy, v.insured))
_PRE = "try_cast(pre_com AS decimal(20,4))"
_FIN = "try_cast(nullif(final_payment, '') AS decimal(20,4))"


def _whole(e):
    return f"cast(trunc({e}) AS bigint)"


query("person_payout", f"""
SELECT cert_no, {_whole(f"sum({_PRE})")} AS prepay_total, {_whole(f"sum({_PRE}) FILTER (case_type = '死亡')")} AS prepay_death,
  {_whole(f"sum({_PRE}) FILTER (case_type = '残疾')")} AS prepay_disable, {_whole(f"sum({_PRE}) FILTER (scene = '工作期间')")} AS prepay_worktime,
  {_whole(f"sum({_PRE}) FILTER (scene IN ('非工作期间', '上下班'))")} AS prepay_nonworktime, {_whole(f"sum({_FIN})")} AS finalpay_total
FROM claims GROUP BY 1""")(lambda v: P.person_payout(v.claims))
query("person_payout_avg", f"""
SELECT cert_no, cast(sum({_PRE}) AS double) / nullif(count(*) FILTER (NOT regexp_matches(pre_com, '[一-龥]')), 0) AS avg_prepay,
  cast(sum({_FIN}) AS double) / count(*) AS avg_finalpay, avg(cast(time_effect AS double)) AS avg_effecttime
FROM claims GROUP BY 1""")(lambda v: P.person_payout_avg(v.claims, digits=None))
