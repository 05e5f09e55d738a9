"""Premium accrual, headcounts, member tiers and warnings."""

import datetime

from pyspark.sql import functions as F

from .. import session
from ..operators import alerts as AL
from ..operators import base as B
from ..operators import channel as CH
from ..operators import claim as C
from ..operators import enterprise as E
from ..operators import headcount as H
from ..operators import headcount_store as HS
from ..operators import members as M
from ..operators import premium as PR
from ..operators import standing as ST
from .catalog import query
from .q_channel import _LIVE, _MAP
from .q_enterprise import DUE_ALL, VALID
from .views import AS_OF

TODAY = AS_OF.replace("-", "")
BEFORE = (datetime.date.fromisoformat(AS_OF) - datetime.timedelta(days=1)).isoformat()
SCOPE = "'外包雇主', '骑士保', '大货车'"


def scope(v):
    return v.product.where(F.col("dim_1").isin("外包雇主", "骑士保", "大货车"))


# oracle tables of the accrual and the daily headcount, by plain day expansion
SPAN = f"""
span AS (SELECT policy_id, ent_id, insured_id, insured_cert_no, sku_charge_type, insured_start_date AS s, insured_end_date AS e,
  cast(round_even(cast(sku_price AS double) / CASE WHEN sku_charge_type = '1' THEN date_diff('day', insured_start_date, insured_end_date) + 1
    ELSE date_diff('day', start_date, end_date) + 1 END, 4) AS decimal(18,4)) AS price
  FROM policy JOIN insured_term USING (policy_id) WHERE policy_status IN ('0','1')
  AND insure_code IN (SELECT product_code FROM product WHERE dim_1 IN ({SCOPE})))"""
PDAY = SPAN + """,
pday AS (SELECT *, strftime(unnest(generate_series(s, e, INTERVAL 1 DAY)), '%Y%m%d') AS day_id FROM span)"""
HEAD = f"""
cal AS (SELECT policy_id, policy_code, ent_id, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS d FROM policy
  WHERE insure_code IN (SELECT product_code FROM product WHERE dim_1 IN ({SCOPE}))),
who AS (SELECT DISTINCT policy_id, insured_cert_no, unnest(generate_series(insured_start_date, insured_end_date, INTERVAL 1 DAY)) AS d FROM insured_term),
head AS (SELECT policy_id, policy_code, ent_id, strftime(d, '%Y%m%d') AS day_id, count(insured_cert_no) AS curr_insured
  FROM cal LEFT JOIN who USING (policy_id, d) GROUP BY 1, 2, 3, 4)"""

query("premium_daily", f"""
WITH {PDAY} SELECT policy_id, insured_id, sku_charge_type, count(*) AS days, cast(sum(price) AS double) AS premium,
  min(day_id) AS first_day, max(day_id) AS last_day FROM pday GROUP BY 1, 2, 3""")(
    lambda v: PR.premium_daily(v.policy, v.insured_term, scope(v)).groupBy("policy_id", "insured_id", "sku_charge_type").agg(
        F.count("*").alias("days"), F.sum("sku_day_price").cast("double").alias("premium"),
        F.min("day_id").alias("first_day"), F.max("day_id").alias("last_day"))
)
query("premium_policy_day", f"""
WITH {PDAY}, t AS (SELECT policy_id, day_id, sum(price) AS p FROM pday GROUP BY 1, 2)
SELECT policy_id, substr(day_id, 1, 6) AS month_id, count(*) AS days, cast(sum(p) AS double) AS premium, cast(max(p) AS double) AS top_day
FROM t GROUP BY 1, 2""")(
    lambda v: PR.premium_policy_day(v.policy, v.insured_term, scope(v)).groupBy("policy_id", F.substring("day_id", 1, 6).alias("month_id")).agg(
        F.count("*").alias("days"), F.sum("charged_premium").cast("double").alias("premium"),
        F.max("charged_premium").cast("double").alias("top_day"))
)
query("premium_policy_to_date", f"""
WITH {PDAY} SELECT policy_id, ent_id, cast(sum(price) AS double) AS charged_premium FROM pday WHERE day_id <= '{TODAY}' GROUP BY 1, 2""")(
    lambda v: PR.premium_to_date(v.policy, v.insured_term, AS_OF, scope(v)).withColumn("charged_premium", F.col("charged_premium").cast("double"))
)
SLOPE_SQL = f"""
WITH {PDAY}, m AS (SELECT ent_id, substr(day_id, 1, 6) AS month_id, sum(price) AS p FROM pday GROUP BY 1, 2 HAVING substr(day_id, 1, 6) < '{TODAY[:6]}'),
o AS (SELECT *, cast(p AS double) AS x, row_number() OVER (PARTITION BY ent_id ORDER BY month_id) AS i,
  row_number() OVER (PARTITION BY ent_id ORDER BY month_id DESC) AS j FROM m),
s AS (SELECT ent_id, count(*) AS n, min(month_id) AS a, max(month_id) AS b, max(x) FILTER (i = 1) AS f, max(p) FILTER (i = 1) AS fd, max(p) FILTER (j = 1) AS ld, max(x) FILTER (j = 1) AS l,
  max(x) FILTER (j = 3) AS t, sum(p) AS total FROM o GROUP BY 1)
SELECT ent_id, a AS first_month, b AS last_month, cast(round(fd, 2) AS double) AS first_premium, cast(round(ld, 2) AS double) AS last_premium,
  round_even(CASE WHEN n < 2 OR f = l THEN 0 ELSE (pow(l / f, 1.0::DOUBLE / (n - 1)) - 1) * 100 END, 2) AS slope,
  round_even(CASE WHEN n >= 3 THEN (sqrt(l / t) - 1) * 100 ELSE 0 END, 2) AS three_slope,
  cast(round(total, 2) AS double) AS premium_all FROM s"""
query("premium_slope", SLOPE_SQL)(
    lambda v: PR.premium_slope(PR.premium_ent_month(v.policy, v.insured_term, scope(v)), AS_OF)
)
query("first_premium", """
WITH c AS (SELECT policy_id, sum(coalesce(add_premium, 0)) - sum(coalesce(del_premium, 0)) AS net FROM premium_change GROUP BY 1)
SELECT policy_id, cast(premium - coalesce(net, 0) AS double) AS first_premium FROM policy LEFT JOIN c USING (policy_id)""")(
    lambda v: PR.first_premium(v.policy, v.premium_change)
)
query("job_type_premium", f"""
WITH p AS (SELECT policy_id, policy_code FROM policy WHERE effect_date <= DATE '{AS_OF}' AND length(policy_code) > 0),
c AS (SELECT insured_work_type, CASE WHEN sku_charge_type = '2' THEN
    cast(round_even((date_diff('day', insured_start_date, insured_end_date) + 1) / 365.0::DOUBLE * cast(sku_price AS double), 2) AS decimal(18,4))
    ELSE cast(sku_price AS decimal(18,4)) END AS amount
  FROM insured JOIN p USING (policy_id) JOIN insured_term USING (policy_id, insured_id) JOIN product_plan USING (policy_code) WHERE length(insured_work_type) > 0)
SELECT insured_work_type, cast(sum(amount) AS double) AS premium, count(*) AS persons FROM c GROUP BY 1""")(
    lambda v: PR.job_type_premium(v.policy, v.insured, v.insured_term, v.product_plan, AS_OF)
)
_PLANS = SPAN.replace("policy JOIN insured_term USING (policy_id)", "(SELECT * EXCLUDE (sku_charge_type, sku_price) FROM policy) JOIN product_plan USING (policy_code) JOIN insured_term USING (policy_id)")
query("premium_by_plans", f"""
WITH {_PLANS}, pday AS (SELECT *, unnest(generate_series(s, e, INTERVAL 1 DAY)) AS d FROM span)
SELECT policy_id, ent_id, cast(sum(price) AS double) AS charged_premium FROM pday WHERE d <= DATE '{AS_OF}' GROUP BY 1, 2""")(
    lambda v: PR.premium_to_date(v.policy, v.insured_term, AS_OF, scope(v), v.product_plan).withColumn("charged_premium", F.col("charged_premium").cast("double"))
)
query("daily_headcount", f"""
WITH {HEAD} SELECT policy_id, policy_code, substr(day_id, 1, 6) AS month_id, count(*) AS days, cast(sum(curr_insured) AS bigint) AS person_days,
  max(curr_insured) AS peak FROM head GROUP BY 1, 2, 3""")(
    lambda v: H.daily_headcount(v.policy, v.insured_term, scope(v)).groupBy("policy_id", "policy_code", F.substring("day_id", 1, 6).alias("month_id")).agg(
        F.count("*").alias("days"), F.sum("curr_insured").alias("person_days"), F.max("curr_insured").alias("peak"))
)


def _kept_up(v):
    """Three runs: a part of the persons with some wrong ends, the others, and the corrections with some policies again."""
    path = session.scratch(v.spark, "headcounts")
    policy = B.in_scope_policies(v.policy, v.product).select(*HS.POLICY)
    persons = session.materialise(v.insured_term.join(policy.select("policy_id"), "policy_id", "left_semi").select(*HS.SPAN), "persons")
    early, wrong = F.col("policy_id") % 3 == 0, F.xxhash64("insured_id") % 5 == 0
    first = persons.where(early).withColumn("insured_end_date", F.when(wrong, F.date_add("insured_end_date", 9)).otherwise(F.col("insured_end_date")))
    HS.apply_changes(v.spark, path, policy.where(early), first, 16, 6)
    HS.apply_changes(v.spark, path, policy.where(~early), persons.where(~early), 16, 6)
    HS.apply_changes(v.spark, path, policy.where(early & (F.col("policy_id") % 2 == 0)), persons.where(early & wrong), 16, 6)
    return HS.daily_headcount(v.spark, path)


query("headcount_kept_up", f"""
WITH {HEAD} SELECT policy_id, policy_code, substr(day_id, 1, 6) AS month_id, count(*) AS days, cast(sum(curr_insured) AS bigint) AS person_days,
  max(curr_insured) AS peak FROM head GROUP BY 1, 2, 3""")(
    lambda v: _kept_up(v).groupBy("policy_id", "policy_code", F.substring("day_id", 1, 6).alias("month_id")).agg(
        F.count("*").alias("days"), F.sum("curr_insured").alias("person_days"), F.max("curr_insured").alias("peak"))
)
query("headcount_ent_day", f"""
WITH {HEAD}, t AS (SELECT ent_id, day_id, sum(curr_insured) AS n FROM head GROUP BY 1, 2)
SELECT ent_id, substr(day_id, 1, 6) AS month_id, cast(sum(n) AS bigint) AS person_days, cast(max(n) AS bigint) AS peak, count(*) AS days
FROM t GROUP BY 1, 2""")(
    lambda v: H.daily_headcount_by_ent(v.policy, v.insured_term, scope(v)).groupBy(
        "ent_id", F.substring("day_id", 1, 6).alias("month_id")).agg(
        F.sum("curr_insured").alias("person_days"), F.max("curr_insured").alias("peak"), F.count("*").alias("days"))
)
query("headcount_month_peak", f"""
WITH {HEAD}, t AS (SELECT ent_id, day_id, sum(curr_insured) AS n FROM head WHERE day_id <= '{TODAY}' GROUP BY 1, 2),
m AS (SELECT ent_id, substr(day_id, 1, 6) AS month_id, max(n) AS peak FROM t GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY ent_id ORDER BY month_id DESC) AS k FROM m)
SELECT ent_id, month_id, cast(peak AS bigint) AS peak FROM r WHERE k = 1""")(
    lambda v: H.headcount_month_peak(H.daily_headcount_by_ent(v.policy, v.insured_term, scope(v)), AS_OF)
)


def people_now(v):
    snap = H.headcount_on(v.policy, v.insured_term, AS_OF, scope(v))
    return H.current_headcount(v.policy, v.channel, scope(v), snap, AS_OF)


NOW = f"""
np AS (SELECT trim(holder_company) AS name, policy_id FROM policy WHERE policy_status IN ('0','1','7','9','10')
  AND insure_code IN (SELECT product_code FROM product WHERE dim_1 IN ({SCOPE}))),
nn AS (SELECT policy_id, count(DISTINCT insured_cert_no) AS n FROM insured_term JOIN policy USING (policy_id)
  WHERE DATE '{AS_OF}' BETWEEN insured_start_date AND insured_end_date AND DATE '{AS_OF}' BETWEEN start_date AND end_date GROUP BY 1),
now_people AS (SELECT ent_id, '{TODAY[:6]}' AS month_id, cast(sum(coalesce(n, 0)) AS bigint) AS cur_insured_persons
  FROM channel LEFT JOIN np ON trim(ent_name) = name LEFT JOIN nn USING (policy_id) GROUP BY 1)"""
query("current_headcount", f"WITH {NOW} SELECT * FROM now_people")(people_now)

EARNED = f"""
acc AS (SELECT policy_id, sum(price) AS amount FROM pday WHERE day_id <= '{TODAY}' GROUP BY 1
  UNION ALL SELECT policy_id, premium FROM policy WHERE policy_status IN ('0','1','7','9','10') AND effect_date <= DATE '{AS_OF}'
  AND insure_code IN (SELECT product_code FROM product WHERE dim_1 = '零工保')),
earn AS (SELECT c.ent_id, cast(sum(amount) AS double) AS charged_premium FROM acc JOIN policy p USING (policy_id)
  JOIN (SELECT DISTINCT trim(ent_name) AS name, ent_id FROM channel) c ON trim(holder_company) = name
  WHERE policy_status IN ('0','1','7','9','10') GROUP BY 1)"""


def earned(v):
    return C.premium_earned(v.policy, v.product, v.channel, PR.premium_to_date(v.policy, v.insured_term, AS_OF, scope(v)), AS_OF)


query("premium_earned", f"WITH {PDAY}, {EARNED} SELECT * FROM earn")(earned)
query("premium_earned_simple", f"""
WITH {PDAY}, p AS (SELECT * FROM policy WHERE {VALID} AND insure_code IN (SELECT product_code FROM product WHERE dim_1 IN ({SCOPE}))),
a AS (SELECT ent_id, premium AS amount FROM p WHERE sku_charge_type <> '2'
  UNION ALL SELECT p.ent_id, price FROM p JOIN pday USING (policy_id) WHERE p.sku_charge_type = '2' AND day_id < '{TODAY}')
SELECT ent_id, cast(sum(amount) AS double) AS charged_premium FROM a GROUP BY 1""")(
    lambda v: C.premium_earned_simple(v.policy, scope(v), PR.premium_to_date(v.policy, v.insured_term, BEFORE, scope(v)))
)

# small limits for the size of the test data
CUTS = M.TierCuts(partner=200, diamonds=60, gold=20, silver=2)


def _tier(v):
    chan = CH.channel_map(v.channel)
    now = ST.policy_standing(v.policy, v.insured_term, AS_OF, scope(v))
    # a row per enterprise, of which both the tiers' money and their headcounts are taken
    sums = session.materialise(M.member_sums(v.policy, v.claims, now, v.channel, v.product, AS_OF), "members")
    live = v.summary_month.where((F.col("data_type") == "totalInsuredPersons") & (F.col("data_val").cast("bigint") > 0))
    people = sums.select("ent_id", F.lit(TODAY[:6]).alias("month_id"), "persons")
    t = M.member_tier(chan, sums, live.select("ent_id", "month_id"), people, AS_OF, CUTS)
    return t.withColumns({"rate": F.round("rate", 6)})


_NOWN = int(AS_OF[:4]) * 12 + int(AS_OF[5:7])
query("member_tier", f"""
WITH {PDAY}, {EARNED}, {NOW}, cm AS ({_MAP}),
due AS (SELECT c.ent_id, sum(coalesce(d, 0)) AS due FROM (SELECT DISTINCT trim(ent_name) AS name, ent_id FROM channel) c
  JOIN policy p ON trim(holder_company) = name
  LEFT JOIN (SELECT policy_no, sum({DUE_ALL}) AS d FROM claims GROUP BY 1) ON policy_no = policy_code WHERE {VALID.replace('ent_id', 'p.ent_id')} GROUP BY 1),
tot AS (SELECT ch, cast(sum(due) AS double) AS due, cast(sum(cast(charged_premium AS decimal(24,4))) AS double) AS earned, sum(cur_insured_persons) AS peak
  FROM cm JOIN now_people USING (ent_id) LEFT JOIN due USING (ent_id) LEFT JOIN earn USING (ent_id) GROUP BY 1),
num AS (SELECT DISTINCT ch, cast(substr(month_id,1,4) AS int) * 12 + cast(substr(month_id,5,2) AS int) AS n FROM ({_LIVE}) JOIN cm USING (ent_id)),
gap AS (SELECT ch, n, lag(n) OVER (PARTITION BY ch ORDER BY n) AS p FROM num),
st AS (SELECT ch, max(n) AS last, max(n) - max(n) FILTER (p IS NULL OR n - p > 1) + 1 AS streak FROM gap GROUP BY 1),
b AS (SELECT *, coalesce(earned, 0) AS e, CASE WHEN coalesce(earned, 0) = 0 THEN CASE WHEN due > 0 THEN 1 ELSE 0 END ELSE due / earned END AS r,
  {_NOWN} BETWEEN last - 8 AND last AS in9, {_NOWN} BETWEEN last - 5 AND last AS in6 FROM tot JOIN st USING (ch)),
t AS (SELECT *, CASE WHEN streak >= 9 AND NOT (in9 AND peak < 200) THEN 'partner' WHEN peak >= 200 THEN 'partner'
  WHEN streak >= 6 AND NOT (in6 AND (peak < 60 OR peak >= 200)) THEN 'diamonds' WHEN peak >= 60 THEN 'diamonds'
  WHEN peak >= 20 THEN 'gold' WHEN peak >= 2 THEN 'silver' ELSE 'ordinary' END AS tier,
  CASE WHEN streak >= 9 AND NOT (in9 AND peak < 200) THEN 'h' WHEN peak >= 200 THEN '3'
  WHEN streak >= 6 AND NOT (in6 AND (peak < 60 OR peak >= 200)) THEN 'h' WHEN peak >= 60 THEN '3'
  WHEN peak >= 2 THEN 'l' ELSE '0' END AS mode FROM b WHERE last >= {_NOWN} AND last - streak < {_NOWN} AND peak > 0),
d AS (SELECT *, CASE mode WHEN '3' THEN 3 WHEN '0' THEN 0 ELSE CASE WHEN r >= 1 THEN 2 WHEN r >= CASE mode WHEN 'h' THEN 0.7 ELSE 0.75 END THEN 1 ELSE 0 END END AS k FROM t)
SELECT ch AS channel, round(due / nullif(e, 0), 6) AS rate, due, e AS earned, tier, k AS downgrade,
  cast(peak AS bigint) AS peak, cast(streak AS bigint) AS streak,
  CASE tier WHEN 'ordinary' THEN 'ordinary' ELSE list_extract(['partner', 'diamonds', 'gold', 'silver', 'ordinary', 'ordinary', 'ordinary'],
    CASE tier WHEN 'partner' THEN 1 WHEN 'diamonds' THEN 2 WHEN 'gold' THEN 3 ELSE 4 END + k) END AS real_tier FROM d""")(_tier)

# ---------------------------------------------------------------- warnings

MIN_CHANGE = 1
SINCE = "2001-07-01"

AIN = f"""{HEAD}, cm AS ({_MAP}),
ed AS (SELECT ent_id, day_id, sum(curr_insured) AS n FROM head GROUP BY 1, 2),
nm AS (SELECT DISTINCT ent_id, trim(holder_company) AS ent_name FROM policy),
ain AS (SELECT ent_id, coalesce(sum(n) FILTER (day_id = '20010731'), 0) AS y, coalesce(sum(n) FILTER (day_id = '{TODAY}'), 0) AS t,
  coalesce(max(n) FILTER (day_id BETWEEN '20010701' AND '20010731'), 0) AS m FROM ed GROUP BY 1 HAVING max(day_id) >= '20010701'),
chg0 AS (SELECT ch AS name, sum(y) AS y, sum(t) AS t, sum(m) AS m FROM ain JOIN nm USING (ent_id) JOIN cm USING (ent_name) GROUP BY 1),
chg AS (SELECT name, cast(y AS bigint) AS y, cast(t AS bigint) AS t, cast(m AS bigint) AS m, cast(t - y AS bigint) AS d,
  CASE WHEN y = 0 THEN 0.0 ELSE (t - y) / y END AS r FROM chg0)"""


def _ents(v):
    return AL.alert_input(v.policy, H.daily_headcount_by_ent(v.policy, v.insured_term, scope(v), SINCE, AS_OF), AS_OF)


def _changes(v):
    return AL.changes(_ents(v), CH.channel_map(v.channel))


_BASE = "json_object('entName', name, 'yesterdayInsuredPersons', y, 'curInsuredPersons', t, "
_S = {
    "surge": f"""SELECT 'ADD' AS type, name, '{TODAY}' AS day_id, cast({_BASE}'addPersons', d, 'ringRatio', printf('%.4f', r),
  'level', CASE WHEN r >= 0.5 THEN '二级' ELSE '一级' END, 'name', '大幅增员预警') AS varchar) AS payload, cast(d AS double) AS value
FROM chg WHERE d >= {MIN_CHANGE} AND r >= 0.1""",
    "drop": f"""SELECT 'DEL' AS type, name, '{TODAY}' AS day_id, cast({_BASE}'addPersons', d, 'ringRatio', printf('%.4f', r),
  'level', CASE WHEN t <= 10 THEN '三级' WHEN r <= -0.5 THEN '二级' ELSE '一级' END, 'name', '大幅减员预警') AS varchar) AS payload,
  cast(d AS double) AS value FROM chg WHERE d <= -{MIN_CHANGE} AND r <= -0.1""",
    "headcount": f"""SELECT 'CUR_INSURED' AS type, name, '{TODAY}' AS day_id, cast({_BASE}'lmhInsuredPersonsMax', m,
  'ringRatio', printf('%.4f', t / m), 'level', CASE WHEN t / m <= 0.2 THEN '三级' WHEN t / m <= 0.5 THEN '二级' ELSE '一级' END,
  'name', '在保人数预警') AS varchar) AS payload, cast(t - m AS double) AS value FROM chg WHERE m <> 0 AND t / m <= 0.7""",
    "lost": f"""SELECT 'LOSS' AS type, name, '{TODAY}' AS day_id, concat('{{"entName":"', name, '","yesterdayInsuredPersons":', y, ',"curInsuredPersons":', t, ',"lmhInsuredPersonsMax":', m,
  ',"firstInsureTime":"', a, '","lastOperTime":"', b, '","totalPremium":', cast(p AS decimal(24,2)), ',"totalPersons":', q,
  ',"name":"客户流失预警"}}') AS payload,
  cast(0 AS double) AS value FROM chg JOIN (SELECT ch, sum(coalesce(add_premium, 0) - coalesce(del_premium, 0)) AS p,
    sum(coalesce(add_persons, 0)) AS q, min(day_id) AS a, max(day_id) AS b FROM premium_change JOIN policy USING (policy_code)
    JOIN cm ON trim(holder_company) = cm.ent_name GROUP BY 1) ON ch = name WHERE t = 0""",
    "death": f"""SELECT 'DEATH' AS type, ch AS name, '{TODAY}' AS day_id, concat('{{"entName":"', ch, '","curInsuredPersons":', sum(t * k),
  ',"chargedPremium":', cast(sum(coalesce(ep, 0) * k) AS decimal(24,2)), ',"payment":', cast(sum(coalesce(pay, 0) * k) AS decimal(24,2)),
  ',"payrate":', CASE WHEN sum(coalesce(pay, 0) * k) = 0 THEN 0.0::DOUBLE WHEN sum(coalesce(ep, 0) * k) = 0 THEN -1.0::DOUBLE
    ELSE cast(sum(coalesce(pay, 0) * k) AS double) / cast(sum(coalesce(ep, 0) * k) AS double) END,
  ',"countDeath":', sum(k), ',"name":"死亡案件预警"}}') AS payload, cast(sum(k) AS double) AS value
FROM (SELECT trim(holder_company) AS ent_name, count(*) AS k FROM claims JOIN policy ON policy_no = policy_code WHERE case_type = '死亡'
  AND try_strptime(risk_date, '%Y/%m/%d') > DATE '{AS_OF}' - INTERVAL 1500 DAY AND try_strptime(risk_date, '%Y/%m/%d') <= DATE '{AS_OF}' GROUP BY 1) dc
JOIN nm USING (ent_name) JOIN ain USING (ent_id)
LEFT JOIN (SELECT trim(holder_company) AS ent_name, sum(premium) AS ep FROM policy GROUP BY 1) USING (ent_name)
LEFT JOIN (SELECT trim(holder_company) AS ent_name, sum(cast(final_payment AS decimal(20,4))) AS pay FROM claims
  JOIN policy ON policy_no = policy_code WHERE length(final_payment) > 0 GROUP BY 1) USING (ent_name)
JOIN cm USING (ent_name) GROUP BY ch""",
}


def _money(v):
    pol = v.policy.withColumn("ent_name", F.trim("holder_company"))
    prem = pol.groupBy("ent_name").agg(F.sum("premium").cast("decimal(24,4)").alias("charged_premium"))
    facts = C.claim_facts(v.claims, "policy_no").select("policy_no", "paid")
    paid = (
        facts.join(pol, F.col("policy_no") == F.col("policy_code")).groupBy("ent_name").agg(F.sum("paid").alias("payment"))
    )
    return prem.join(paid, "ent_name", "left")


def _alerts(v, shared=False):
    chan = CH.channel_map(v.channel)
    ents = _ents(v)
    if shared:  # five warnings read the same headcounts
        ents = session.materialise(ents, "alert-input")
    ch = AL.changes(ents, chan)
    return {
        "surge": AL.surge(ch, AS_OF, MIN_CHANGE),
        "drop": AL.drop(ch, AS_OF, MIN_CHANGE),
        "headcount": AL.headcount_fall(ch, AS_OF),
        "lost": AL.lost(ch, AL.premium_history(v.policy, v.premium_change, chan), AS_OF),
        "death": AL.deaths(ents, v.policy, v.claims, _money(v), chan, AS_OF),
    }


for _k, _sql in _S.items():
    query(f"alerts_{_k}", f"WITH {AIN} {_sql}")(lambda v, k=_k: _alerts(v)[k])
query("alerts_all", f"WITH {AIN} " + " UNION ALL ".join(f"SELECT * FROM ({s})" for s in _S.values()))(
    lambda v: AL.all_alerts(*_alerts(v, shared=True).values())
)
