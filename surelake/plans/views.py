"""Stand-in business tables over the test data.

Each is one SELECT in the SQL that Spark and DuckDB share, so a query and its
SQL twin read the same table. The library itself never depends on them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

AS_OF = "2001-08-01"
EVENT_AS_OF = "2024-01-31"

# 18-character card: region, birthday, sequence (its last digit carries the gender), check digit.
_CARD = (
    "concat(cast(10 + {p} % 25 AS string), '0101', "
    "replace(cast(DATE '1960-01-01' + cast(({p} * 37) % 14600 AS int) AS string), '-', ''), "
    "lpad(cast({p} % 1000 AS string), 3, '0'), cast({p} % 10 AS string))"
)
CARD_L = _CARD.format(p="l_partkey")

#: the columns of a person row, the same with and without the dates of the insurance
_INSURED = """l_orderkey AS policy_id,
       concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string),
              '-', cast(l_suppkey AS string)) AS insured_id,
       p_name AS insured_name, card AS insured_cert_no,
       concat('138', lpad(cast(l_partkey + CASE WHEN l_quantity > 49 AND l_discount > 0.09 THEN 1 ELSE 0 END AS string),
              8, '0')) AS insured_mobile,
       p_type AS insured_work_type, CASE l_linestatus WHEN 'O' THEN '1' ELSE '2' END AS insure_policy_status,
       concat('Company ', cast(l_suppkey AS string)) AS insured_company_name,
       CASE WHEN l_linenumber = 7 AND l_quantity > 40 THEN card ELSE '' END AS child_cert_no"""

VIEWS: dict[str, str] = {
    "policy": """
SELECT o_orderkey AS policy_id, concat('POL', cast(o_orderkey AS string)) AS policy_code,
       concat('E', cast(o_custkey AS string)) AS ent_id, c_name AS holder_company,
       substr(o_orderpriority, 1, 1) AS insure_code,
       CASE o_orderstatus WHEN 'O' THEN '1' WHEN 'F' THEN '0'
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN '7' ELSE '4' END END AS policy_status,
       cast(o_totalprice AS decimal(15,2)) AS premium,
       cast(o_orderdate AS date) AS policy_create_time, cast(o_orderdate AS date) AS start_date,
       cast(o_orderdate AS date) + 89 AS end_date, cast(o_orderdate AS date) AS effect_date,
       cast(o_orderdate AS date) + 30 AS policy_update_time,
       CASE WHEN o_custkey % 2 = 0 THEN '1' ELSE '2' END AS sku_charge_type,
       cast(floor(o_totalprice / 1000) AS decimal(15,2)) AS sku_price,
       cast(10 * (1 + o_orderkey % 5) AS string) AS sku_coverage,
       concat('K', substr(o_orderpriority, 1, 1), o_orderstatus) AS sku_code
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "product_plan": """
SELECT policy_code, sku_charge_type, sku_price FROM policy
UNION ALL SELECT policy_code, CASE sku_charge_type WHEN '1' THEN '2' ELSE '1' END, cast(sku_price + 7 AS decimal(15,2)) FROM policy WHERE policy_id % 7 = 0""",
    "person": f"""
SELECT p_partkey, p_name, p_type, {_CARD.format(p='p_partkey')} AS card,
       DATE '1960-01-01' + cast((p_partkey * 37) % 14600 AS int) AS birthday
FROM part""",
    "insured": f"SELECT {_INSURED} FROM lineitem JOIN person ON l_partkey = p_partkey",
    "insured_detail": f"""
SELECT {_INSURED}, birthday AS insured_birthday, cast(o_orderdate AS date) + l_linenumber AS insured_start_date,
       cast(o_orderdate AS date) + l_linenumber + cast(l_quantity AS int) AS insured_end_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN person ON l_partkey = p_partkey""",
    "insured_term": """
SELECT l_orderkey AS policy_id,
       concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string),
              '-', cast(l_suppkey AS string)) AS insured_id,
       card AS insured_cert_no, birthday AS insured_birthday,
       cast(o_orderdate AS date) + l_linenumber AS insured_start_date,
       cast(o_orderdate AS date) + l_linenumber + cast(l_quantity AS int) AS insured_end_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN person ON l_partkey = p_partkey""",
    "work_level": """
SELECT * FROM (VALUES ('ECONOMY', 1), ('SMALL', 2), ('MEDIUM', 3), ('STANDARD', 4), ('LARGE', 5)) AS t(work_type, ai_level)""",
    "product": """
SELECT * FROM (VALUES ('1', 'Urgent snow race', '外包雇主', '体育'), ('2', 'High swim', '骑士保', '体育'),
  ('3', 'Medium rider', '大货车', '雇主'), ('4', 'Casual labour', '零工保', '雇主'), ('5', 'Low marathon race', '其他', '体育'))
  AS t(product_code, product_name, dim_1, product_type_1)""",
    "claims": f"""
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string),
              '-', cast(l_suppkey AS string)) AS id,
       concat('POL', cast(l_orderkey AS string)) AS policy_no, {CARD_L} AS cert_no,
       CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN '死亡' WHEN l_returnflag = 'R' THEN '残疾' ELSE '受伤' END AS case_type,
       CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN '死亡' WHEN l_returnflag = 'R' THEN '十级' ELSE '无' END AS disable_level,
       CASE WHEN l_linestatus = 'O' THEN '工作期间' WHEN l_linenumber % 2 = 1 THEN '非工作期间' ELSE '上下班' END AS scene,
       CASE WHEN l_tax = 0.08 THEN '拒赔' WHEN l_tax = 0.0 THEN '撤案' ELSE '处理中' END AS status,
       CASE WHEN l_discount >= 0.09 THEN '是' ELSE '否' END AS overtime,
       CASE WHEN l_discount <= 0.01 THEN '是' ELSE '否' END AS if_resubmit_paper,
       concat(cast(year(l_shipdate) AS string), '/', cast(month(l_shipdate) AS string), '/', cast(day(l_shipdate) AS string)) AS risk_date,
       CASE WHEN l_discount = 0.1 THEN '2000/13/40' WHEN l_discount = 0.06 THEN '未报案' ELSE concat(
            cast(year(cast(l_shipdate AS date) + cast(l_quantity AS int) % 20) AS string), '/',
            cast(month(cast(l_shipdate AS date) + cast(l_quantity AS int) % 20) AS string), '/',
            cast(day(cast(l_shipdate AS date) + cast(l_quantity AS int) % 20) AS string)) END AS report_date,
       CASE WHEN l_tax < 0.02 THEN NULL ELSE concat(
            cast(year(cast(l_shipdate AS date) + cast(l_quantity AS int) % 20 + l_linenumber) AS string), '/',
            cast(month(cast(l_shipdate AS date) + cast(l_quantity AS int) % 20 + l_linenumber) AS string), '/',
            cast(day(cast(l_shipdate AS date) + cast(l_quantity AS int) % 20 + l_linenumber) AS string)) END AS paper_finish_date,
       CASE WHEN l_quantity = 13 THEN '=13' WHEN l_quantity = 17 THEN '未结' ELSE cast(cast(l_quantity AS int) AS string) END AS finish_days,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE cast(l_linenumber AS string) END AS time_effect,
       CASE WHEN l_linenumber = 7 THEN '#N/A' WHEN l_linenumber = 6 AND l_tax > 0.06 THEN '待定'
            ELSE cast(cast(l_extendedprice AS decimal(15,2)) AS string) END AS pre_com,
       CASE WHEN l_discount >= 0.05 THEN '' ELSE cast(cast(l_extendedprice AS decimal(15,2)) AS string) END AS final_payment,
       cast(l_quantity AS int) AS risk_period
FROM lineitem WHERE l_returnflag <> 'N'""",
    "risk_period": f"""
SELECT concat('POL', cast(l_orderkey AS string)) AS policy_no, {CARD_L} AS cert_no, cast(l_quantity AS int) AS risk_period
FROM lineitem WHERE l_returnflag <> 'N'""",
    "endorse": """
SELECT l_orderkey AS policy_id, l_orderkey * 10 + l_linenumber AS preserve_id,
       CASE WHEN l_tax >= 0.04 THEN '4' WHEN l_tax >= 0.02 THEN '5' ELSE '1' END AS preserve_status,
       concat('C', cast(l_suppkey % 2 AS string)) AS insured_cert_no,
       CASE l_returnflag WHEN 'R' THEN '2' WHEN 'A' THEN '1' ELSE '3' END AS insured_changetype
FROM lineitem""",
    "ent_month": """
SELECT ent_id, month_id, cast(sum(a) AS int) AS a, cast(sum(n) AS int) AS n, cast(sum(r) AS int) AS r, cast(count(*) AS int) AS t
FROM (SELECT concat('E', cast(o_custkey AS string)) AS ent_id,
             substr(replace(cast(cast(l_shipdate AS date) AS string), '-', ''), 1, 6) AS month_id, l_partkey,
             count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS a, count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS n,
             count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS r
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3) AS per_person
GROUP BY ent_id, month_id""",
    "summary_month": """
SELECT ent_id, month_id, 'totalInsuredPersons' AS data_type, cast(t AS string) AS data_val FROM ent_month
UNION ALL SELECT ent_id, month_id, 'monAddPersons', cast(a AS string) FROM ent_month
UNION ALL SELECT ent_id, month_id, 'monRenewalPersons', cast(n AS string) FROM ent_month
UNION ALL SELECT ent_id, month_id, 'monSubPersons', cast(r AS string) FROM ent_month""",
    "premium_change": """
SELECT l_orderkey AS policy_id, concat('POL', cast(l_orderkey AS string)) AS policy_code,
       CASE WHEN l_returnflag = 'A' THEN cast(l_extendedprice AS decimal(15,2)) END AS add_premium,
       CASE WHEN l_returnflag = 'A' THEN cast(l_quantity AS int) END AS add_persons,
       CASE WHEN l_returnflag = 'R' THEN cast(l_extendedprice AS decimal(15,2)) END AS del_premium,
       replace(cast(cast(l_shipdate AS date) AS string), '-', '') AS day_id
FROM lineitem""",
    "sum_level": """
SELECT concat('E', cast(c_custkey AS string)) AS ent_id, cast(cast(floor(abs(c_acctbal) / 10) AS int) AS string) AS ent_scale,
       c_mktsegment AS ent_influence_level
FROM customer""",
    "enterprise": """
SELECT concat('E', cast(c_custkey AS string)) AS id, c_name AS ent_name, cast(n_nationkey AS string) AS office_province,
       cast(n_nationkey AS string) AS office_city, '2000-01-01 08:00:00' AS first_insure_time,
       DATE '1995-01-01' + cast(c_custkey % 900 AS int) AS create_time,
       cast(c_nationkey % 3 AS string) AS triangle_status
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "cant": """
SELECT cast(n_nationkey AS string) AS code, n_name AS name, concat('short ', n_name) AS short_name FROM nation""",
    "city_grade": """
SELECT cast(n_nationkey AS string) AS city_code, r_name AS city_grade FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "certificate": """
SELECT * FROM (VALUES ('0', 'licence'), ('1', 'credit code'), ('2', '')) AS t(id_nub, certificate)""",
    "channel": """
SELECT concat('E', cast(c_custkey AS string)) AS ent_id, c_name AS ent_name,
       CASE WHEN n_regionkey = 0 THEN '直客' ELSE n_name END AS channel_name,
       CASE WHEN n_regionkey = 0 THEN c_name ELSE n_name END AS channel,
       concat('Sales ', cast(n_nationkey AS string)) AS salesman, concat('Op ', cast(n_regionkey AS string)) AS biz_operator
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v1_person": f"""
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string), '-', cast(l_suppkey AS string)) AS id,
       cast(l_orderkey AS string) AS policy_id, concat('张三', chr(10), cast(l_partkey AS string)) AS name,
       concat(CASE WHEN l_quantity > 25 THEN '电工' ELSE '焊' END, chr(10), 'x') AS work_type, concat({CARD_L}, chr(10)) AS cert_no,
       CASE WHEN l_tax = 0.0 THEN 'obsolete' WHEN l_tax < 0.02 THEN NULL ELSE 'ok' END AS remark, '1' AS status,
       cast(cast(l_shipdate AS date) AS string) AS start_date
FROM lineitem WHERE l_linestatus = 'O'""",
    "v1_child": f"""
SELECT concat('c', cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string), '-', cast(l_suppkey AS string)) AS id,
       concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string), '-', cast(l_suppkey AS string)) AS insured_id,
       {CARD_L} AS child_cert_no
FROM lineitem WHERE l_linestatus = 'O' AND l_linenumber = 7""",
    "v1_policy": """
SELECT cast(o_orderkey AS string) AS id, cast(o_orderkey AS string) AS policy_id, cast(o_orderkey AS string) AS order_id,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN '9999' WHEN o_orderstatus = 'P' THEN NULL
            ELSE cast(o_custkey AS string) END AS user_id,
       CASE o_orderpriority WHEN '5-LOW' THEN '15000001' ELSE substr(o_orderpriority, 1, 1) END AS insure_code,
       concat(CASE WHEN o_orderstatus = 'F' THEN 'PRE' ELSE 'POL' END, cast(o_orderkey AS string)) AS policy_code,
       cast(o_totalprice AS decimal(15,2)) AS premium, CASE o_orderstatus WHEN 'O' THEN '1' ELSE '0' END AS status,
       cast(cast(o_orderdate AS date) AS string) AS start_date, cast(cast(o_orderdate AS date) + 89 AS string) AS end_date,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE cast(cast(o_orderdate AS date) AS string) END AS order_date,
       concat('K', substr(o_orderpriority, 1, 1), o_orderstatus) AS sku_id
FROM orders""",
    "v1_order": """
SELECT cast(o_orderkey AS string) AS order_id, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN '9999'
            WHEN o_orderstatus = 'P' THEN NULL ELSE cast(o_custkey AS string) END AS user_id,
       cast(o_totalprice AS decimal(15,2)) AS pay_amount, cast(cast(o_orderdate AS date) - 1 AS string) AS order_create_time, '10' AS quantity
FROM orders""",
    "v1_first_premium": """
SELECT cast(o_orderkey AS string) AS policy_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE cast(o_totalprice AS decimal(15,2)) - 10 END AS pay_amount
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "v1_holder": """
SELECT cast(o_orderkey AS string) AS policy_id, c_name AS holder_name, n_name AS holder_province
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "ent_map": """
SELECT concat('POL', cast(o_orderkey AS string)) AS policy_code, concat('E', cast(o_custkey AS string)) AS ent_id FROM orders""",
    "ent_info": """
SELECT concat('E', cast(c_custkey AS string)) AS ent_id, c_name AS ent_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS office_province
FROM customer""",
    "v2_person": f"""
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string), '-', cast(l_partkey AS string), '-', cast(l_suppkey AS string)) AS id,
       concat('N', cast(l_orderkey AS string)) AS policy_no, concat(chr(10), '李', cast(l_partkey AS string), '四') AS name, '木工' AS work_type,
       {CARD_L} AS cert_no, CASE WHEN l_tax > 0.05 THEN '2' ELSE '1' END AS cert_type, CASE l_returnflag WHEN 'R' THEN '0' ELSE '1' END AS status,
       concat('N', cast(l_orderkey * 10 + l_linenumber % 3 AS string)) AS revise_no, l_returnflag AS revise_status,
       CASE WHEN l_tax = 0.07 THEN NULL ELSE cast(cast(l_shipdate AS date) AS string) END AS start_date,
       CASE WHEN l_discount = 0.0 THEN NULL ELSE cast(cast(l_shipdate AS date) + 400 AS string) END AS end_date
FROM lineitem WHERE l_linestatus = 'F'""",
    "v2_child": """
SELECT concat('s', cast(o_orderkey AS string)) AS id, concat('N', cast(o_orderkey AS string)) AS policy_no, 'child' AS name,
       CASE o_orderstatus WHEN 'O' THEN '1' ELSE '0' END AS status
FROM orders WHERE o_orderpriority = '3-MEDIUM'""",
    "v2_policy": """
SELECT concat('V', cast(o_orderkey AS string)) AS id, concat('V', cast(o_orderkey AS string)) AS policy_id, concat('N', cast(o_orderkey AS string)) AS policy_no,
       concat('POL', cast(o_orderkey AS string)) AS insurance_policy_no, concat('POL', cast(o_orderkey AS string)) AS policy_code,
       substr(o_orderpriority, 1, 1) AS insure_code, cast(o_totalprice AS decimal(15,2)) AS premium,
       CASE o_orderstatus WHEN 'F' THEN '0' ELSE '1' END AS status, cast(cast(o_orderdate AS date) AS string) AS start_date,
       cast(cast(o_orderdate AS date) + 400 AS string) AS end_date
FROM orders""",
    "v2_plan": """
SELECT concat('N', cast(l_orderkey AS string)) AS policy_no, l_quantity AS plan_amount, cast(l_linenumber AS string) AS contain_trainee,
       l_discount AS injure_percent, CASE l_returnflag WHEN 'N' THEN 2 ELSE 1 END AS payment_type FROM lineitem""",
    "v2_holder": """
SELECT concat('N', cast(o_orderkey AS string)) AS policy_no, c_name AS holder_name FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v1_endorse": """
SELECT l_orderkey AS preserve_id, l_orderkey AS policy_id, concat('POL', cast(l_orderkey AS string)) AS policy_code, '4' AS preserve_status,
       count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS add_person_count, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS del_person_count,
       min(cast(l_shipdate AS date)) AS start_date, max(cast(l_shipdate AS date)) AS end_date
FROM lineitem GROUP BY 1, 2, 3""",
    "v1_endorse_person": f"""
SELECT l_orderkey AS preserve_id, '王五' AS name, {CARD_L} AS cert_no, concat('瓦工', chr(10)) AS work_type, l_returnflag AS change_type,
       CASE WHEN l_returnflag = 'A' THEN cast(l_shipdate AS date) END AS join_date,
       CASE WHEN l_returnflag = 'R' THEN cast(l_shipdate AS date) END AS left_date,
       CASE WHEN l_tax = 0.0 THEN 'obsolete' WHEN l_tax < 0.03 THEN NULL ELSE 'ok' END AS remark FROM lineitem""",
    "v2_endorse": """
SELECT concat('N', cast(l_orderkey AS string)) AS policy_no, concat('N', cast(l_orderkey * 10 + l_linenumber % 3 AS string)) AS revise_no,
       concat('N', cast(l_orderkey * 10 + l_linenumber % 3 AS string)) AS preserve_id,
       count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS add_person_count, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS del_person_count
FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2, 3""",
    "facts": """
SELECT DISTINCT i.insured_name, insured_cert_no, insured_mobile, product_type FROM insured i JOIN policy USING (policy_id)
JOIN (VALUES ('1', '雇主'), ('2', '体育'), ('3', '健康'), ('4', '教育')) AS t(code, product_type) ON insure_code = code""",
    "mobile_place": """
SELECT concat('138', lpad(cast(p_partkey AS string), 8, '0')) AS mobile, p_brand AS province, p_type AS city, 'mobile' AS operator
FROM part WHERE p_size <= 40""",
    "customers_crm": """
SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS channel, cast(c_nationkey AS string) AS source, cast(c_nationkey % 4 AS string) AS detail,
       cast(cast(floor(abs(c_acctbal) / 1000) AS int) AS string) AS level, DATE '2000-01-01' + cast(c_custkey % 500 AS int) AS update_time FROM customer""",
    "options_crm": """
SELECT 'channel' AS field, s AS key, concat('seg ', lower(s)) AS value FROM (SELECT DISTINCT c_mktsegment AS s FROM customer WHERE c_mktsegment <> 'BUILDING') t
UNION ALL SELECT 'source', cast(n_nationkey AS string), n_name FROM nation
UNION ALL SELECT 'detail', cast(r_regionkey AS string), r_name FROM region""",
    "business_crm": """
SELECT DISTINCT o_custkey AS customer_id, o_orderstatus AS sale_process, CASE WHEN o_orderstatus = 'F' THEN concat(' Ent ', o_orderpriority, ' ') END AS ent_name FROM orders""",
    "team": """
SELECT concat('Sales ', cast(n_nationkey AS string)) AS sale_name, CASE WHEN n_regionkey = 1 THEN NULL ELSE concat('Team ', cast(n_regionkey AS string)) END AS team_name FROM nation""",
    "work_grade": """
SELECT concat('POL', cast(o_orderkey AS string)) AS policy_code, concat('class ', cast(o_orderkey % 4 AS string)) AS profession_type FROM orders""",
    "policy_place": """
SELECT policy_code, cast(c_nationkey AS string) AS office_province, cast(c_nationkey AS string) AS office_city
FROM policy JOIN customer ON holder_company = c_name""",
    "place_names": """
SELECT cast(n_nationkey AS string) AS code, CASE n_nationkey WHEN 3 THEN '北京市' ELSE n_name END AS short_name FROM nation""",
    "people_sources": """
SELECT card AS cert, concat('138', lpad(cast(l_partkey AS string), 8, '0')) AS mobile,
       cast(cast(o_orderdate AS date) + l_linenumber AS string) AS create_time,
       cast(cast(o_orderdate AS date) + l_linenumber + cast(l_quantity AS int) AS string) AS end_time,
       '官网' AS product_code, '产品官网' AS customer_name, p_type AS identity, p_name AS insured_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN person ON l_partkey = p_partkey
UNION ALL
SELECT insured_cert_no, '', replace(substr(cast(start_date AS string), 1, 19), 'T', ' '), replace(substr(cast(end_date AS string), 1, 19), 'T', ' '),
       'ofo', 'rides', '', insured_name FROM rides""",
    "sku_term": """
SELECT * FROM (VALUES ('K1O', '50123', '10'), ('K1F', '30221', '20'), ('K2O', '501', '30'), ('K2F', '80312', '40'),
  ('K3P', '20111', '50'), ('K4O', '1234', '60'), ('K5F', '60105', '70'), ('K5O', NULL, '80')) AS t(sku_code, term_three, term_one)""",
    "rides": """
SELECT concat(cast(10 + user_id % 25 AS string), '0101', replace(cast(DATE '1960-01-01' + cast((user_id * 37) % 14600 AS int) AS string), '-', ''),
              lpad(cast(user_id % 1000 AS string), 3, '0'), cast(user_id % 10 AS string)) AS insured_cert_no,
       ts AS start_date, ts + INTERVAL 2 HOUR AS end_date,
       CASE event_type WHEN 'click' THEN 'OFO00001' WHEN 'view' THEN 'OFO00002' ELSE '' END AS product_code,
       concat('Rider ', cast(user_id AS string)) AS insured_name
FROM events""",
    "web_action": """
SELECT row_key AS idaction, name FROM (
  SELECT DISTINCT event_type AS row_key, concat('action/', event_type) AS name FROM events) AS a""",
    "web_visit": """
SELECT concat(cast(user_id AS string), '-', cast(cast(ts AS date) AS string)) AS idvisit, min(event_id) AS idvisitor,
       min(ts) AS visit_first_action_time, max(ts) AS visit_last_action_time, count(*) AS visit_total_actions
FROM events GROUP BY 1""",
    "web_link": """
SELECT event_id AS idlink, concat(cast(user_id AS string), '-', cast(cast(ts AS date) AS string)) AS idvisit,
       event_id AS idvisitor, event_type AS idaction_url,
       CASE WHEN value > 20 THEN 'purchase' WHEN value > 10 THEN 'missing' END AS idaction_name, ts AS server_time
FROM events""",
    "log_lines": """
SELECT concat(replace(substr(cast(ts AS string), 1, 19), 'T', ' '), '.000 [', CASE WHEN event_type IN ('error', 'click') THEN 'ERROR' ELSE 'WARN ' END,
              '] [main] (pkg.Job', cast(user_id % 5 AS string), ':', cast(user_id % 100 AS string), ') ] handler] failed - ',
              CASE WHEN value > 15 THEN concat('cause ', cast(cast(floor(value / 10) AS int) AS string)) ELSE '' END) AS value
FROM events""",
    "knowledge": """
SELECT q.conv_id * 1000 + q.turn AS id, q.text AS query, a.text AS answer,
       CASE WHEN q.conv_id % 5 = 0 THEN '默认' WHEN q.conv_id % 3 = 0 THEN 'business' ELSE 'work' END AS category
FROM conversations q JOIN conversations a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1
WHERE q.role = 'user' AND a.role = 'assistant'""",
    "questions": "SELECT item_id AS question_id, text AS question FROM benchmark",
    "ledger_big": f"""
SELECT concat('POL', cast(l_orderkey AS string)) AS policy_no, cast(l_linenumber AS string) AS batch_no,
       cast(l_extendedprice AS decimal(15,2)) AS premium, cast(l_quantity AS decimal(15,2)) AS settlement
FROM lineitem""",
    "ledger_small": """
SELECT concat('POL', cast(o_orderkey AS string)) AS policy_no,
       CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '8' END AS batch_no,
       cast(o_totalprice AS decimal(15,2)) AS premium, cast(floor(o_totalprice / 10) AS decimal(15,2)) AS settlement
FROM orders WHERE o_orderpriority <> '5-LOW'""",
}


def referenced(sql: str, given: tuple[str, ...] = ()) -> list[str]:
    """Stand-in tables a text names, dependencies first; ``given`` ones exist already."""
    out: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in out and name not in given and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text, re.I):
                visit(VIEWS[name])
                if name not in out:
                    out.append(name)

    visit(sql)
    return out


def with_views(sql: str, given: tuple[str, ...] = ()) -> str:
    """Prefix a statement with the stand-in tables it reads."""
    needed = referenced(sql, given)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


class Inputs:
    """Tables and stand-in tables of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str, prepared: str | None = None):
        """``prepared``: folder written by ``prepare`` for the same data; its tables are read instead."""
        self.spark, self.folder, self.prepared = spark, folder.rstrip("/"), prepared

    def __getattr__(self, name: str) -> DataFrame:
        if self.prepared and name in PREPARED:
            return self.spark.read.parquet(f"{self.prepared}/{name}")
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in VIEWS:
            return self.sql(f"SELECT * FROM {name}")
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        given = tuple(PREPARED) if self.prepared else ()
        text = with_views(text, given)
        for t in (*TABLES, *given):
            if re.search(rf"\b{t}\b", text):
                getattr(self, t).createOrReplaceTempView(t)
        return self.spark.sql(text)


#: the larger tables, worth writing once when many queries run over the same data
PREPARED = "documents events policy insured insured_detail insured_term claims risk_period endorse summary_month people_sources".split()


def prepare(spark: SparkSession, folder: str, out: str, files: int) -> None:
    """Write tables and stand-in tables the way a loaded lake holds them: typed, and in several files each.

    The test tables are single files of one row group, which a scan can only read with one task.
    """
    source = Inputs(spark, folder)
    for name in PREPARED:
        getattr(source, name).repartition(files).write.parquet(f"{out}/{name}")
