"""Enterprise, claim and base labels."""

from ..operators import base as B
from ..operators import claim as C
from ..operators import enterprise as E
from .catalog import query
from .views import AS_OF

VALID = "policy_status IN ('0','1','7','9','10') AND length(ent_id) > 0"

query("valid_policy_count", f"SELECT ent_id, count(*) AS effective_policy FROM policy WHERE {VALID} GROUP BY 1")(
    lambda v: E.valid_policy_count(v.policy)
)
query("regulation_times", """
SELECT ent_id, count(DISTINCT preserve_id) AS ent_add_regulation_times
FROM policy JOIN endorse USING (policy_id) WHERE preserve_status IN ('4','5') AND length(ent_id) > 0 GROUP BY 1""")(
    lambda v: E.regulation_times(v.policy, v.endorse)
)
query("regulation_times_monthly", """
WITH r AS (SELECT ent_id, count(DISTINCT preserve_id) AS n FROM policy JOIN endorse USING (policy_id)
           WHERE preserve_status IN ('4','5') GROUP BY 1),
m AS (SELECT ent_id, count(*) AS months FROM summary_month WHERE data_type = 'totalInsuredPersons' GROUP BY 1)
SELECT ent_id, cast(ceil(n / months) AS bigint) AS ent_month_regulation_times FROM r JOIN m USING (ent_id)""")(
    lambda v: E.regulation_times_monthly(v.policy, v.endorse, v.summary_month)
)


def _month_label(key, label, sql, *kinds):
    query(key, sql)(lambda v: E.month_summary_labels(v.summary_month, *kinds).select("ent_id", label))


_month_label("persons_added", "ent_add_sum_persons", """
SELECT ent_id, cast(sum(cast(data_val AS bigint)) FILTER (data_type IN ('monAddPersons','monRenewalPersons')) AS bigint)
  AS ent_add_sum_persons FROM summary_month GROUP BY 1""", "monAddPersons", "monRenewalPersons")
_month_label("persons_removed", "ent_del_sum_persons", """
SELECT ent_id, cast(sum(cast(data_val AS bigint)) AS bigint) AS ent_del_sum_persons
FROM summary_month WHERE data_type = 'monSubPersons' GROUP BY 1""", "monSubPersons")
_month_label("persons_renewed", "ent_continuous_plc_persons", """
SELECT ent_id, cast(sum(cast(data_val AS bigint)) AS bigint) AS ent_continuous_plc_persons
FROM summary_month WHERE data_type = 'monRenewalPersons' GROUP BY 1""", "monRenewalPersons")
_month_label("headcount_month_avg", "ent_month_plc_persons", """
SELECT ent_id, cast(floor(sum(cast(data_val AS bigint)) / count(*)) AS bigint) AS ent_month_plc_persons
FROM summary_month WHERE data_type = 'totalInsuredPersons' GROUP BY 1""", "totalInsuredPersons")
_month_label("months_in_force", "ent_continuous_plc_month", """
SELECT ent_id, string_agg(month_id, '-' ORDER BY month_id) AS ent_continuous_plc_month
FROM (SELECT DISTINCT ent_id, month_id FROM summary_month
      WHERE data_type = 'totalInsuredPersons' AND cast(data_val AS bigint) > 0) GROUP BY 1""", "totalInsuredPersons")

STREAK_SQL = """
WITH months AS ({months}),
num AS (SELECT DISTINCT {key}, cast(substr(month_id,1,4) AS int) * 12 + cast(substr(month_id,5,2) AS int) AS n FROM months),
gap AS (SELECT {key}, n, lag(n) OVER (PARTITION BY {key} ORDER BY n) AS p FROM num),
start AS (SELECT {key}, max(n) FILTER (p IS NULL OR n - p > 1) AS s, max(n) AS e FROM gap GROUP BY 1)
SELECT {key}, cast(e - s + 1 AS bigint) AS {out} FROM start"""
query("months_streak", STREAK_SQL.format(
    key="ent_id", out="month_number",
    months="SELECT ent_id, month_id FROM summary_month WHERE data_type = 'totalInsuredPersons' AND cast(data_val AS bigint) > 0"))(
    lambda v: E.months_streak(v.summary_month).select("ent_id", "month_number")
)
query("months_since_first", f"""
SELECT ent_id, cast(greatest(1, floor(date_diff('day', min(policy_create_time), DATE '{AS_OF}') / 30)) AS bigint)
  AS ent_fist_plc_month FROM policy WHERE {VALID} GROUP BY 1""")(lambda v: E.months_since_first(v.policy, AS_OF))

query("job_type_count", f"""
SELECT ent_id, count(DISTINCT insured_work_type) AS ent_insure_craft FROM policy JOIN insured USING (policy_id)
WHERE {VALID} AND length(insured_work_type) > 0 GROUP BY 1""")(lambda v: E.job_type_count(v.policy, v.insured))

for _n, _name in ((1, "first"), (2, "second"), (3, "third")):
    query(f"job_type_top{_n}", f"""
WITH c AS (SELECT ent_id, work_type, count(*) AS n FROM policy JOIN insured USING (policy_id)
  JOIN work_level ON insured_work_type = work_type WHERE insure_policy_status = '1' AND length(ent_id) > 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY ent_id ORDER BY n DESC, work_type) AS k FROM c)
SELECT ent_id, concat(work_type, '|', n) AS ent_{_name}_craft FROM r WHERE k = {_n}""")(
        lambda v, n=_n: E.job_type_nth(v.policy, v.insured, v.work_level, n)
    )

query("job_type_max_paid", """
WITH c AS (SELECT ent_id, work_type, cast(final_payment AS decimal(20,2)) AS paid FROM policy JOIN insured USING (policy_id)
  JOIN work_level ON insured_work_type = work_type JOIN claims ON policy_code = policy_no
  WHERE insure_policy_status = '1' AND length(final_payment) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY ent_id ORDER BY paid DESC, work_type) AS k FROM c)
SELECT ent_id, concat(work_type, '|', paid) AS ent_most_money_craft FROM r WHERE k = 1""")(
    lambda v: E.job_type_max_paid(v.policy, v.insured, v.work_level, v.claims)
)
query("job_type_most_claims", """
WITH c AS (SELECT ent_id, insured_work_type AS w, count(*) AS n FROM policy JOIN insured USING (policy_id)
  JOIN claims ON policy_code = policy_no WHERE insure_policy_status = '1' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY ent_id ORDER BY n DESC, w) AS k FROM c)
SELECT ent_id, concat(w, '|', n) AS ent_most_count_craft FROM r WHERE k = 1""")(
    lambda v: E.job_type_most_claims(v.policy, v.insured, v.claims)
)
query("insured_rate", f"""
WITH p AS (SELECT ent_id, count(DISTINCT insured_cert_no) AS n FROM policy JOIN insured USING (policy_id)
  WHERE {VALID} AND insure_policy_status = '1' GROUP BY 1),
s AS (SELECT ent_id, max(cast(ent_scale AS int)) AS scale FROM sum_level GROUP BY 1)
SELECT ent_id, round(n / scale * 100, 2) AS insured_rate FROM p JOIN s USING (ent_id) WHERE scale > 0""")(
    lambda v: E.insured_rate(v.policy, v.insured, v.sum_level)
)
query("potential_headcount", f"""
WITH p AS (SELECT ent_id, count(*) AS n FROM policy JOIN insured USING (policy_id)
  WHERE {VALID} AND insure_policy_status = '1' AND length(insured_cert_no) = 18 GROUP BY 1)
SELECT ent_id, max(greatest(cast(ent_scale AS bigint) - n, 0)) AS ent_potential_scale FROM p JOIN sum_level USING (ent_id)
GROUP BY 1""")(lambda v: E.potential_headcount(v.policy, v.insured, v.sum_level))
query("insured_times", f"""
SELECT ent_id, count(*) AS total_insured_count FROM policy JOIN insured USING (policy_id) WHERE {VALID} GROUP BY 1""")(
    lambda v: E.insured_times(v.policy, v.insured)
)
query("insured_persons", f"""
SELECT ent_id, count(DISTINCT insured_cert_no) AS total_insured_persons FROM policy JOIN insured USING (policy_id)
WHERE {VALID} GROUP BY 1""")(lambda v: E.insured_persons(v.policy, v.insured))
query("insured_persons_current", """
SELECT ent_id, count(DISTINCT insured_cert_no) AS cur_insured_persons FROM policy JOIN insured USING (policy_id)
WHERE policy_status = '1' AND insure_policy_status = '1' AND length(ent_id) > 0 GROUP BY 1""")(
    lambda v: E.insured_persons_current(v.policy, v.insured)
)
query("premium_total", f"SELECT ent_id, cast(sum(premium) AS double) AS total_premium FROM policy WHERE {VALID} GROUP BY 1")(
    lambda v: E.premium_total(v.policy)
)
_PM = f"""
WITH p AS (SELECT ent_id, cast(sum(premium) AS double) AS s FROM policy WHERE {VALID} GROUP BY 1),
m AS (SELECT ent_id, count(*) AS months FROM summary_month WHERE data_type = 'totalInsuredPersons' GROUP BY 1)
SELECT ent_id, s / months{{mul}} AS {{out}} FROM p JOIN m USING (ent_id)"""
query("premium_month_avg", _PM.format(mul="", out="avg_month_premium"))(
    lambda v: E.premium_month_avg(v.policy, v.summary_month)
)
query("premium_year_avg", _PM.format(mul=" * 12", out="avg_year_premium"))(
    lambda v: E.premium_year_avg(v.policy, v.summary_month)
)
query("premium_per_person", f"""
WITH p AS (SELECT ent_id, cast(sum(premium) AS double) AS s FROM policy WHERE {VALID} GROUP BY 1),
m AS (SELECT ent_id, count(DISTINCT insured_cert_no) AS n FROM policy JOIN insured USING (policy_id) WHERE {VALID} GROUP BY 1)
SELECT ent_id, s / n AS avg_person_premium FROM p JOIN m USING (ent_id)""")(
    lambda v: E.premium_per_person(v.policy, v.insured)
)
query("mode_value", """
WITH c AS (SELECT policy_id, insured_work_type AS w, count(*) AS n FROM insured GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY policy_id ORDER BY n DESC, w) AS k FROM c)
SELECT policy_id, w AS mode_value FROM r WHERE k = 1""")(
    lambda v: E.mode_value(v.insured, "policy_id", "insured_work_type")
)

# ------------------------------------------------------------------ claims

DUE = """CASE WHEN coalesce(regexp_matches(pre_com, '[一-龥]'), false) THEN NULL
  ELSE try_cast(coalesce(nullif(final_payment, ''), pre_com) AS decimal(20,4)) END"""
DUE_ALL = f"CASE WHEN pre_com <> '#N/A' THEN {DUE} END"
OWN = "FROM policy JOIN claims ON policy_code = policy_no WHERE length(ent_id) > 0"


def _claim(key, label, expr, where="", having=""):
    query(key, f"SELECT ent_id, {expr} AS {label} {OWN} {where} GROUP BY 1 {having}")(
        lambda v: C.label(v.claims, v.policy, label)
    )


_claim("claim_count_by_ent", "report_num", "count(*)")
_claim("claim_closed_count", "claim_num", "count(*)", "AND length(paper_finish_date) > 0")
_claim("claim_death_count", "death_num", "count(*)", "AND case_type = '死亡'")
_claim("claim_disability_count", "disability_num", "count(*)", "AND case_type = '残疾'")
_claim("claim_worktime_count", "worktime_num", "count(*)", "AND scene = '工作期间'")
_claim("claim_offwork_count", "nonworktime_num", "count(*)", "AND scene IN ('非工作期间', '上下班')")
_SUM = f"cast(sum({DUE}) AS double)"
_HAS = f"HAVING sum({DUE}) IS NOT NULL"
_claim("payout_expected_death", "pre_death_compensation", _SUM, "AND case_type = '死亡'", _HAS)
_claim("payout_expected_disability", "pre_dis_compensation", _SUM, "AND disable_level NOT IN ('无', '死亡')", _HAS)
_claim("payout_expected_worktime", "pre_wt_compensation", _SUM, "AND scene = '工作期间'", _HAS)
_claim("payout_expected_offwork", "pre_nwt_compensation", _SUM, "AND scene IN ('非工作期间', '上下班')", _HAS)
_claim("payout_paid", "all_compensation", "cast(sum(cast(final_payment AS decimal(20,4))) AS double)", "AND length(final_payment) > 0")
_claim("material_integrity", "ent_material_integrity", "round(1 - count(*) FILTER (if_resubmit_paper = '是') / count(*), 4)",
       having="HAVING count(*) FILTER (if_resubmit_paper = '是') > 0")
_D = "try_strptime({}, '%Y/%m/%d')"
_DELAY = f"greatest(abs(date_diff('day', {_D.format('risk_date')}, {_D.format('report_date')})), 1)"
_claim("report_delay_avg", "ent_report_time", f"round(avg({_DELAY}), 4)", f"AND {_D.format('report_date')} IS NOT NULL")
_claim("claim_ageing_avg", "avg_aging_claim",
       f"round(avg(abs(date_diff('day', {_D.format('risk_date')}, {_D.format('paper_finish_date')}))), 4)",
       "AND length(paper_finish_date) > 0")
_claim("settle_days_avg", "avg_aging_cps",
       "round(avg(CASE WHEN regexp_matches(finish_days, '[一-龥]') THEN 0 ELSE cast(finish_days AS double) END), 4)",
       "AND length(finish_days) BETWEEN 1 AND 9 AND finish_days NOT LIKE '%=%'")
_claim("large_case_rate", "largecase_rate",
       "round((count(*) FILTER (case_type = '死亡') + count(*) FILTER (case_type = '残疾')) / count(*), 4)",
       having="HAVING count(*) FILTER (case_type = '死亡') > 0 AND count(*) FILTER (case_type = '残疾') > 0")

query("payout_expected", f"""
WITH m AS (SELECT DISTINCT trim(ent_name) AS name, ent_id FROM channel),
p AS (SELECT trim(holder_company) AS name, policy_code FROM policy WHERE {VALID}),
d AS (SELECT policy_no, sum({DUE_ALL}) AS due FROM claims GROUP BY 1)
SELECT m.ent_id, cast(sum(coalesce(due, 0)) AS double) AS pre_all_compensation
FROM m JOIN p USING (name) LEFT JOIN d ON policy_code = policy_no GROUP BY 1""")(
    lambda v: C.payout_expected_of_members(v.claims, v.policy, v.channel)
)


def _flag(key, label, cond):
    query(key, f"SELECT ent_id, count(DISTINCT id) AS {label} {OWN} AND {cond} GROUP BY 1")(
        lambda v: C.flagged(v.claims, v.policy, label)
    )


_flag("claim_overtime_count", "overtime_compensation_num", "overtime = '是'")
_flag("claim_rejected_count", "ent_rejected_count", "status = '拒赔'")
_flag("claim_withdrawn_count", "ent_withdrawn_count", "status = '撤案'")

query("claim_rate", f"""
WITH c AS (SELECT ent_id, count(*) AS n {OWN} GROUP BY 1),
t AS (SELECT ent_id, count(*) AS m FROM policy JOIN insured USING (policy_id) WHERE {VALID} GROUP BY 1)
SELECT ent_id, round(n * 100 / m, 4) AS ent_monthly_risk FROM c JOIN t USING (ent_id)""")(
    lambda v: C.claim_rate(v.claims, v.policy, v.insured)
)
_LEVEL = """SELECT ent_id, ai_level, count(DISTINCT insured_cert_no) AS persons FROM policy JOIN insured USING (policy_id)
JOIN work_level ON insured_work_type = work_type WHERE insure_policy_status = '1' GROUP BY 1, 2"""
query("risk_level_headcount", _LEVEL)(lambda v: C.risk_level_headcount(v.policy, v.insured, v.work_level))
query("risk_level_pivot", f"WITH l AS ({_LEVEL}) SELECT ent_id, " + ", ".join(
    f"max(persons) FILTER (ai_level = {i}) AS worktype_{i}_count" for i in range(8)) + " FROM l GROUP BY 1")(
    lambda v: C.risk_level_pivot(v.policy, v.insured, v.work_level)
)
query("frequent_removals", """
WITH o AS (SELECT policy_id, insured_cert_no FROM endorse WHERE insured_changetype = '2' GROUP BY 1, 2 HAVING count(*) > 2)
SELECT ent_id, count(DISTINCT insured_cert_no) AS ent_employee_increase FROM o JOIN policy USING (policy_id) GROUP BY 1""")(
    lambda v: C.frequent_removals(v.policy, v.endorse)
)
_RISK = "FROM policy JOIN risk_period ON policy_code = policy_no"
query("risk_period_avg", f"SELECT ent_id, round(avg(risk_period), 4) AS avg_aging_risk {_RISK} GROUP BY 1")(
    lambda v: C.risk_period_label(v.policy, v.risk_period, "avg_aging_risk")
)
query("risk_short_count", f"SELECT ent_id, count(*) AS mix_period_count {_RISK} WHERE risk_period < 3 GROUP BY 1")(
    lambda v: C.risk_period_label(v.policy, v.risk_period, "mix_period_count")
)
query("risk_short_rate", f"""
SELECT ent_id, round(count(*) FILTER (risk_period < 3) / count(*), 4) AS mix_period_rate {_RISK}
GROUP BY 1 HAVING count(*) FILTER (risk_period < 3) > 1""")(
    lambda v: C.risk_period_label(v.policy, v.risk_period, "mix_period_rate")
)

# -------------------------------------------------------------------- base

query("product_set", """
SELECT ent_id, string_agg(insure_code, '|' ORDER BY insure_code) AS ent_insure_code FROM (
  SELECT DISTINCT ent_id, insure_code FROM policy WHERE policy_status IN ('0','1','7','9','10')) GROUP BY 1""")(
    lambda v: B.product_set(v.policy)
)
query("gender_share", """
WITH g AS (SELECT ent_id, count(*) AS n, cast(sum(cast(substr(insured_cert_no, 17, 1) AS int) % 2) AS bigint) AS m
  FROM policy JOIN insured USING (policy_id) WHERE length(insured_cert_no) = 18 GROUP BY 1)
SELECT ent_id, round(m / n * 100, 2) AS men_share, round((n - m) / n * 100, 2) AS women_share FROM g""")(
    lambda v: B.gender_share(v.policy, v.insured)
)
query("insured_age_avg", """
SELECT ent_id, round(avg(year(insured_start_date) - year(insured_birthday) - CASE WHEN
  month(insured_start_date) * 100 + day(insured_start_date) < month(insured_birthday) * 100 + day(insured_birthday)
  THEN 1 ELSE 0 END), 4) AS ent_employee_age FROM policy JOIN insured_term USING (policy_id) GROUP BY 1""")(
    lambda v: B.insured_age_avg(v.policy, v.insured_term)
)
query("ent_profile", """
SELECT DISTINCT id AS ent_id, ent_name, split_part(first_insure_time, ' ', 1) AS first_insure_time, p.name AS ent_province,
  c.short_name AS ent_city, city_grade AS ent_city_type, certificate AS ent_type, ent_scale, ent_influence_level
FROM enterprise LEFT JOIN cant p ON office_province = p.code LEFT JOIN cant c ON office_city = c.code
LEFT JOIN city_grade ON office_city = city_code
LEFT JOIN certificate ON triangle_status = id_nub AND length(certificate) > 0
LEFT JOIN sum_level ON id = ent_id""")(
    lambda v: B.ent_profile(v.enterprise, v.cant, v.city_grade, v.certificate, v.sum_level)
)
query("ent_names", "SELECT id AS ent_id, ent_name FROM enterprise UNION SELECT ent_id, ent_name FROM channel")(
    lambda v: B.ent_names(v.enterprise, v.channel)
)
query("policy_latest_owner", """
WITH r AS (SELECT policy_code, ent_id, row_number() OVER (PARTITION BY policy_code ORDER BY create_time DESC, ent_id DESC) AS k
  FROM policy JOIN enterprise ON ent_id = id)
SELECT policy_code, ent_id AS policy_ent_id FROM r WHERE k = 1""")(lambda v: B.latest_owner(v.policy, v.enterprise))
query("policy_profile", """
SELECT policy_code, insure_code AS policy_insure_code, cast(start_date AS varchar) AS policy_start_date,
  cast(end_date AS varchar) AS policy_end_date, coalesce(cast(premium AS varchar), '') AS policy_premium, policy_status,
  cast(policy_update_time AS varchar) AS policy_update_time FROM policy WHERE length(policy_code) > 4""")(
    lambda v: B.policy_profile(v.policy)
)
query("policy_coverage", """
SELECT policy_code, substr(term_three, 1, 2) AS policy_term_three FROM policy JOIN sku_term USING (sku_code)
WHERE length(term_three) > 3""")(lambda v: B.policy_coverage(v.policy, v.sku_term))
query("plan_decode", """
SELECT policy_code, CASE WHEN length(term_three) = 5 THEN substr(term_three, 1, 2) ELSE term_one END AS sku_coverage,
  CASE WHEN length(term_three) = 5 THEN substr(term_three, 3, 1) END AS sku_append,
  CASE WHEN length(term_three) = 5 THEN substr(term_three, 4, 1) END AS sku_charge_type,
  CASE WHEN length(term_three) = 5 THEN substr(term_three, 5, 1) END AS sku_ratio
FROM policy JOIN sku_term USING (sku_code)""")(
    lambda v: v.policy.select("policy_code", "sku_code").join(B.plan_decode(v.sku_term), "sku_code").drop("sku_code")
)
query("product_semi_filter", """
SELECT policy_id, insure_code FROM policy
WHERE insure_code IN (SELECT product_code FROM product WHERE dim_1 IN ('外包雇主', '骑士保', '大货车'))""")(
    lambda v: B.in_scope_policies(v.policy, v.product).select("policy_id", "insure_code")
)
