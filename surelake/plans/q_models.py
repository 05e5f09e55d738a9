"""Feature, model and review queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import session
from ..functions import scalars as S
from ..operators import claim as C
from ..operators import enterprise as E
from ..operators import models as M
from ..operators import tree_sweep as TS
from ..operators import person as P
from ..operators import premium as PR
from ..operators import profile as PF
from ..sources import sinks
from . import q_channel as QC
from .catalog import query
from .q_premium import SLOPE_SQL, scope
from .q_text import VALUE_SQL
from .views import AS_OF, EVENT_AS_OF

#: every component of the vectors
DIMS = [f"f{i}" for i in range(1, 65)]


def _emb(v):
    return v.embeddings.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(DIMS)])


_E = "SELECT vec_id, " + ", ".join(f"cast(embedding[{i}] AS double) AS f{i}" for i in range(1, 65)) + " FROM embeddings"
query("feature_standardise", f"""
WITH e AS ({_E}) SELECT vec_id, """ + ", ".join(f"round((f{i} - avg(f{i}) OVER ()) / stddev_samp(f{i}) OVER (), 4) AS f{i}" for i in range(1, 65)) + " FROM e")(
    lambda v: M.standardise(_emb(v), DIMS, 4)
)
query("feature_minmax", f"""
WITH e AS ({_E}) SELECT vec_id, """ + ", ".join(f"round((f{i} - min(f{i}) OVER ()) / (max(f{i}) OVER () - min(f{i}) OVER ()), 4) AS f{i}" for i in range(1, 65)) + " FROM e")(
    lambda v: M.minmax(_emb(v), DIMS, 4)
)


def ent_wide(v):
    """Wide labels behind the enterprise features."""
    people = E.people_labels(v.policy, v.insured_detail, v.sum_level).select(
        "ent_id", F.round(F.col("men") / F.col("gender_n") * 100, 2).alias("men_share"), F.round((F.col("gender_n") - F.col("men")) / F.col("gender_n") * 100, 2).alias("women_share"),
        F.round(S.ratio("years", "age_n"), 4).alias("ent_employee_age"), "cur_insured_persons", "ent_potential_scale", "ent_scale")
    parts = [
        people,
        C.risk_level_pivot(v.policy, v.insured, v.work_level),
        C.claim_labels(v.claims, v.policy).select(
            "ent_id", "death_num", "disability_num", "report_num", "all_compensation", "pre_all_compensation", "avg_aging_risk"),
    ]
    out = v.policy.select("ent_id").distinct()
    for p in parts:
        out = out.join(p, "ent_id", "left")
    return out


def ent_features(v):
    return M.risk_features(ent_wide(v))


def _wide_sql():
    from .q_enterprise import DUE_ALL, OWN, VALID

    return f"""
g AS (SELECT ent_id, count(*) AS n, sum(cast(substr(insured_cert_no, 17, 1) AS int) % 2) AS m FROM policy JOIN insured USING (policy_id) GROUP BY 1),
w AS (SELECT ent_id, ai_level, count(DISTINCT insured_cert_no) AS c FROM policy JOIN insured USING (policy_id) JOIN work_level ON insured_work_type = work_type
  WHERE insure_policy_status = '1' GROUP BY 1, 2),
wt AS (SELECT ent_id, arg_min(ai_level, ai_level - c * 100) AS wl FROM w GROUP BY 1),
cl AS (SELECT ent_id, count(*) AS rep, count(*) FILTER (case_type = '死亡') AS dea, count(*) FILTER (case_type = '残疾') AS dis, sum({DUE_ALL}) AS due,
  sum(try_cast(nullif(final_payment, '') AS decimal(20,4))) AS paid {OWN} GROUP BY 1),
rk AS (SELECT ent_id, round(avg(risk_period), 4) AS rp FROM policy JOIN risk_period ON policy_code = policy_no GROUP BY 1),
cur AS (SELECT ent_id, count(DISTINCT insured_cert_no) AS n FROM policy JOIN insured USING (policy_id) WHERE policy_status = '1' AND insure_policy_status = '1' GROUP BY 1),
act AS (SELECT ent_id, count(*) AS n FROM policy JOIN insured USING (policy_id) WHERE {VALID} AND insure_policy_status = '1' GROUP BY 1),
sz AS (SELECT ent_id, cast(ent_scale AS int) AS scale FROM sum_level),
ag AS (SELECT ent_id, round(avg(year(insured_start_date) - year(insured_birthday) - CASE WHEN month(insured_start_date) * 100 + day(insured_start_date)
  < month(insured_birthday) * 100 + day(insured_birthday) THEN 1 ELSE 0 END), 4) AS age FROM policy JOIN insured_term USING (policy_id) GROUP BY 1)
SELECT e.ent_id, cast(CASE WHEN coalesce(scale, 0) > 0 THEN coalesce(wl, 1) ELSE 1 END AS double) AS work_type, cast(coalesce(cur.n, 0) AS double) AS cur_insured_persons,
  coalesce(round(g.m / g.n * 100, 2), 0.0) AS man, coalesce(round((g.n - g.m) / g.n * 100, 2), 0.0) AS woman, coalesce(age, 0.0) AS ent_employee_age,
  cast(coalesce(dea, 0) AS double) AS death_num, cast(coalesce(dis, 0) AS double) AS disability_num, cast(coalesce(rep, 0) AS double) AS report_num,
  coalesce(rp, 0.0) AS avg_aging_risk, cast(CASE WHEN act.n IS NULL THEN 0 ELSE greatest(scale - act.n, 0) END AS double) AS ent_potential_scale,
  0.0::DOUBLE AS ent_city, coalesce(cast(paid AS double), 0.0) AS all_compensation, coalesce(cast(due AS double), 0.0) AS pre_all_compensation, 0.0::DOUBLE AS charged_premium
FROM (SELECT DISTINCT ent_id FROM policy) e LEFT JOIN g USING (ent_id) LEFT JOIN wt USING (ent_id) LEFT JOIN cl USING (ent_id) LEFT JOIN rk USING (ent_id)
LEFT JOIN cur USING (ent_id) LEFT JOIN act USING (ent_id) LEFT JOIN sz USING (ent_id) LEFT JOIN ag USING (ent_id)"""


query("risk_features", "WITH " + _wide_sql())(ent_features)


_RISK = "CASE WHEN work_type <= 1 THEN 0 WHEN work_type <= 2 THEN 1 WHEN work_type <= 3 THEN 2 ELSE 3 END"


def training(v):
    """Enterprise features with a risk class that follows from one few-valued feature, so every prediction is known."""
    return session.materialise(ent_features(v).withColumn("risk", F.expr(_RISK).cast("double")), "training")


query("model_risk_tree", f"WITH w AS ({'WITH ' + _wide_sql()}) SELECT ent_id, cast({_RISK} AS int) AS risk_value FROM w")(
    lambda v: (lambda t: M.score(M.train_tree(t, M.ENT_FEATURES, "risk"), t, ["ent_id"], "risk_value"))(training(v))
)


def _sweep(v):
    """Errors by depth and bins where a class follows from one of eight values: null where the split decides."""
    t = v.events.select((F.col("user_id") % 8).cast("double").alias("f1"), F.floor((F.col("user_id") % 8) / 2).cast("double").alias("label"))
    got = M.tree_sweep(session.materialise(t, "sweep"), ["f1"], "label")
    open_ = ((F.col("parameter") == "depth") & (F.col("value") == 2)) | ((F.col("parameter") == "bins") & (F.col("value") == 4))
    return got.select("parameter", "value", F.when(~open_, F.col("rmsle") < 1e-9).alias("exact"))


query("model_tree_sweep", """
SELECT parameter, cast(value AS int) AS value, CASE WHEN parameter || value NOT IN ('depth2', 'bins4') THEN parameter || value NOT IN ('depth1', 'bins2') END AS exact
FROM (SELECT 'depth' AS parameter, unnest([1, 2, 3, 4, 5, 10, 20]) AS value UNION ALL SELECT 'bins', unnest([2, 4, 8, 16, 32, 64, 100]))
WHERE (SELECT count(*) FROM events) > 0""")(_sweep)
# four classes of two values each: the first cut parts the lower two from the upper two, the second level is exact; with two bins there is one cut
query("model_tree_errors", """
WITH e AS (SELECT cast(user_id % 8 AS int) // 2 AS label, event_id % 5 = 0 AS test FROM events),
p AS (SELECT label // 2 AS half, arg_max(label, (n, -label)) AS pred FROM (SELECT label, count(*) AS n FROM e WHERE NOT test GROUP BY 1) GROUP BY 1),
r AS (SELECT round(sqrt(avg(pow(ln(1 + pred) - ln(1 + label), 2))), 9) AS x FROM e JOIN p ON half = label // 2 WHERE test)
SELECT parameter, cast(value AS int) AS value, CASE WHEN parameter || value IN ('depth1', 'bins2') THEN x ELSE 0.0 END AS rmsle
FROM r, (SELECT 'depth' AS parameter, unnest([1, 2, 3, 4, 5, 10, 20]) AS value UNION ALL SELECT 'bins', unnest([2, 4, 8, 16, 32, 64, 100]))""")(
    lambda v: (lambda t: TS.sweep(t.where("event_id % 5 <> 0"), t.where("event_id % 5 = 0"), ["noise", "f1"], "label", 4).withColumn("rmsle", F.round("rmsle", 9)))(
        v.events.select("event_id", F.lit(1.0).alias("noise"), (F.col("user_id") % 8).cast("double").alias("f1"), F.floor((F.col("user_id") % 8) / 2).cast("int").alias("label")))
)
query("model_metrics", """
SELECT 'mse' AS metric, round(avg(pow(user_id % 2 - event_id % 2, 2)), 9) AS value FROM events
UNION ALL SELECT 'test_error', round(count(*) FILTER (user_id % 2 <> event_id % 2) / count(*), 9) FROM events""")(
    lambda v: M.metrics(v.events.select((F.col("user_id") % 2).cast("double").alias("prediction"), (F.col("event_id") % 2).cast("double").alias("label")), "label")
    .withColumn("value", F.round("value", 9))
)


def _people(v):
    cards = PF.id_card_features(v.insured, AS_OF).withColumnRenamed("insured_cert_no", "cert")
    months = v.insured_term.groupBy(F.col("insured_cert_no").alias("cert")).agg(F.min("insured_start_date").alias("d"))

    prof = cards.join(months, "cert").select(
        "cert", "gender", "age", F.when(F.col("province_code") < "200000", "一线城市").otherwise("其他").alias("grade"),
        S.whole_months("d", F.lit(AS_OF)).alias("insure_to_month"))
    pay = P.person_payout(v.claims).select(F.col("cert_no").alias("cert"), "prepay_total", "finalpay_total")
    craft = P.person_any(v.policy, v.insured, v.work_level).select(F.col("insured_cert_no").alias("cert"), "user_craft_level")
    rides = PF.ride_behaviour(PF.ride_facts(v.rides, EVENT_AS_OF), EVENT_AS_OF).select(F.col("insured_cert_no").alias("cert"), "early_night")
    return M.person_features(prof, pay, craft, rides)


_MON = """(year(b) - year(a)) * 12 + month(b) - month(a) - CASE WHEN day(b) >= least(day(a), day(last_day(b))) THEN 0 ELSE 1 END"""
query("person_features", f"""
WITH p AS (SELECT insured_cert_no AS cert, min(insured_start_date) AS a, DATE '{AS_OF}' AS b FROM insured_term GROUP BY 1),
pay AS (SELECT cert_no, trunc(sum(CASE WHEN regexp_matches(pre_com, '[一-龥]') THEN NULL ELSE try_cast(pre_com AS decimal(20,4)) END)) AS pre,
  coalesce(trunc(sum(try_cast(nullif(final_payment, '') AS decimal(20,4)))), 0) AS fin FROM claims GROUP BY 1),
cr AS (SELECT insured_cert_no, min(ai_level) AS lv FROM insured LEFT JOIN work_level ON insured_work_type = work_type GROUP BY 1),
rd AS (SELECT insured_cert_no, count(*) FILTER (hour(start_date) >= 22 OR hour(start_date) <= 3) AS o, count(*) FILTER (hour(start_date) BETWEEN 4 AND 7) AS e FROM rides GROUP BY 1)
SELECT cert, cast(CASE WHEN coalesce(fin, 0) = 0 THEN coalesce(pre, 0) ELSE fin END AS double) AS money,
  CASE WHEN e > o AND e >= 10 THEN 1.0::DOUBLE WHEN o > e AND o >= 10 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS early_res, cast(coalesce(lv, 0) AS double) AS user_craft_level,
  cast({AS_OF[:4]} - cast(substr(cert, 7, 4) AS int) AS double) AS age, CASE WHEN substr(cert, 1, 2) < '20' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS city_level,
  cast(cast(substr(cert, 17, 1) AS int) % 2 AS double) AS sex, cast({_MON} AS double) AS insure_to_month
FROM p LEFT JOIN pay ON cert_no = cert LEFT JOIN cr ON cr.insured_cert_no = cert LEFT JOIN rd ON rd.insured_cert_no = cert""")(_people)
query("rider_features", f"""
WITH r AS (SELECT insured_cert_no, count(*) AS n, count(*) FILTER (hour(start_date) >= 22 OR hour(start_date) <= 3) AS o,
  count(*) FILTER (hour(start_date) BETWEEN 4 AND 7) AS e FROM rides GROUP BY 1)
SELECT insured_cert_no, cast({EVENT_AS_OF[:4]} - cast(substr(insured_cert_no, 7, 4) AS int) AS double) AS age, cast(concat(substr(insured_cert_no, 1, 2), '0000') AS double) AS province_code,
  cast(n AS double) AS rides, CASE WHEN (o > e AND o >= 10) OR (e > o AND e >= 10) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS habit FROM r""")(
    lambda v: M.rider_features(PF.ride_behaviour(PF.ride_facts(v.rides, EVENT_AS_OF), EVENT_AS_OF), PF.id_card_features(v.rides, EVENT_AS_OF))
)


def _kmeans(v):
    """Sizes of the clusters; which person falls where hangs on the start, their number and sum do not."""
    t = session.materialise(_people(v), "people")
    sizes = M.cluster_sizes(M.train_kmeans(t, M.PERSON_FEATURES, k=7), t)
    return sizes.agg(F.sum("members").alias("members"), F.count_if(~F.col("cluster").between(0, 6)).alias("strange"), (F.count("*") <= 7).alias("within_k"))


query("model_kmeans", "SELECT count(DISTINCT insured_cert_no) AS members, 0 AS strange, true AS within_k FROM insured_term")(_kmeans)


# groups so far apart that every start ends in them: sizes, centres and costs are known
_GROUPS = "SELECT cast((user_id % {k}) * 1000 + event_id % 10 AS double) AS x, cast((user_id % {k}) * 500 AS double) + value / 1000 AS y FROM events"


def _centres(v, k):
    t = session.materialise(v.sql(_GROUPS.format(k=k)), "groups")
    model = M.train_kmeans(t, ["x", "y"], k=k, scaler="standard" if k == 3 else "minmax")
    got = M.cluster_report(model, t, ["x", "y"])
    return got.select("members", *[F.round(c, 6).alias(c) for c in ("centre_x", "centre_y", "cost")])


for _k, _scale in ((3, "(x - avg(x) OVER ()) / stddev_samp(x) OVER () AS x, (y - avg(y) OVER ()) / stddev_samp(y) OVER () AS y"),
                   (7, "(x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()) AS x, (y - min(y) OVER ()) / (max(y) OVER () - min(y) OVER ()) AS y")):
    query(f"model_kmeans_centres_{_k}", f"""
WITH g AS ({_GROUPS.format(k=_k)}), n AS (SELECT cast(floor(x / 1000) AS int) AS c, {_scale} FROM g)
SELECT count(*) AS members, round(avg(x), 6) AS centre_x, round(avg(y), 6) AS centre_y, round((var_pop(x) + var_pop(y)) * count(*), 6) AS cost FROM n GROUP BY c""")(
        lambda v, k=_k: _centres(v, k))


def _kmeans_costs(v):
    """Cost around one centre, and whether more centres cost less."""
    got = M.kmeans_sweep(session.materialise(_emb(v), "sweep"), DIMS)
    whole = F.max(F.when(F.col("k") == 1, F.col("cost"))).over(Window.partitionBy(F.lit(1)))  # one row per k
    return got.select("k", F.when(F.col("k") == 1, F.round("cost", 4)).alias("cost"), (F.col("cost") <= whole + 1e-9).alias("less"))


query("model_kmeans_sweep", f"""
WITH e AS ({_E}), c AS (SELECT round({' + '.join(f"var_pop(f{i}) * count(*) / pow(max(f{i}) - min(f{i}), 2)" for i in range(1, 65))}, 4) AS cost FROM e)
SELECT k, CASE WHEN k = 1 THEN cost END AS cost, true AS less FROM c, (SELECT unnest([1, 3, 5, 7, 9]) AS k)""")(_kmeans_costs)


def _scores(v):
    t = training(v)
    path = session.scratch(v.spark, "model")
    M.save(M.train_tree(t, M.ENT_FEATURES, "risk"), path)
    slope = PR.premium_slope(PR.premium_ent_month(v.policy, v.insured_term, scope(v)), AS_OF)
    return M.enterprise_scores(t, slope, M.load(path))


query("model_score", f"""
WITH w AS ({'WITH ' + _wide_sql()}), sl AS ({SLOPE_SQL}),
t AS (SELECT ent_id, work_type, cur_insured_persons AS people, premium_all AS premium, three_slope AS growth FROM w JOIN sl USING (ent_id)), {VALUE_SQL}
SELECT ent_id, cast(round(cast(a * 0.3::DOUBLE + b * 0.35::DOUBLE + c * 0.35::DOUBLE AS decimal(18,6)), 2) AS double) AS enter_value, cast({_RISK} AS int) AS risk_value FROM s JOIN w USING (ent_id)""")(_scores)

# ------------------------------------------------------------------ reviews

_REV = """
SELECT concat('E', cast(user_id AS string)) AS ent_id, concat('C', cast(event_id AS string)) AS cert_no, cast(event_id % 4 AS int) AS report, cast(user_id % 3 AS int) AS person,
  value AS value, cast(1 + user_id % 3 AS int) AS risk, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN '从宽审核' ELSE '正常审核' END AS conclusion FROM events"""
_CON = f"""
WITH r AS ({_REV}), s AS (SELECT ent_id, cert_no, conclusion, report * 50 * 0.25 + person * 50 * 0.25 + CASE WHEN value > 40 THEN 0 WHEN value > 20 THEN 50 ELSE 100 END * 0.25
  + (risk - 1) * 50 * 0.25 AS score FROM r WHERE report <= 2),
c AS (SELECT ent_id, cert_no, cast(score AS double) AS score, conclusion, CASE WHEN score > 0 AND score <= 25 THEN '从宽审核' WHEN score > 25 AND score <= 50 THEN '正常审核'
  WHEN score > 50 AND score <= 75 THEN '审慎审核' WHEN score > 75 THEN '建议拒绝' ELSE '()' END AS model_conclusion FROM s)"""
query("review_conclusion", f"{_CON} SELECT ent_id, cert_no, score, model_conclusion FROM c")(lambda v: M.review_conclusion(v.sql(_REV)))
query("review_compare", f"{_CON} SELECT ent_id, cert_no, score, model_conclusion, conclusion, cast(model_conclusion = conclusion AS int) AS agrees FROM c WHERE conclusion IS NOT NULL")(
    lambda v: M.review_compare(M.review_conclusion(v.sql(_REV)), v.sql(_REV).select("cert_no", "conclusion"))
)

# ------------------------------------------------------------------- sinks


def _store(v):
    path = session.scratch(v.spark, "labels")
    rows = QC.label_rows(v)
    other = rows.limit(1).select("entity_id", F.lit("old").alias("family"), F.lit("gone").alias("label"), "value", "num")
    sinks.write_labels(rows.unionByName(other), path)
    # a second write of one label replaces it and leaves the rest; a label computed without rows is emptied
    sinks.write_labels(rows.where(F.col("label") == "effective_policy"), path, [("insureinfo", "effective_policy"), ("old", "gone")])
    return sinks.read_labels(v.spark, path).select("entity_id", "family", "label", "num")


query("sink_labels", f"SELECT entity_id, family, label, num FROM ({QC.LABEL_ROWS})")(_store)


def _days(v):
    path = session.scratch(v.spark, "days")
    e = v.events.select("event_id", F.date_format("ts", "yyyyMMdd").alias("day_id"), "event_type")
    sinks.replace_days(e, path)
    sinks.replace_days(e.where(F.col("day_id") == "20240115").withColumn("event_type", F.lit("replaced")), path)
    return v.spark.read.parquet(path).select("event_id", F.col("day_id").cast("string").alias("day_id"), "event_type")


query("sink_day_replace", """
SELECT event_id, strftime(ts, '%Y%m%d') AS day_id, CASE WHEN strftime(ts, '%Y%m%d') = '20240115' THEN 'replaced' ELSE event_type END AS event_type FROM events""")(_days)


def _overwrite(v):
    path = session.scratch(v.spark, "orders")
    sinks.overwrite(v.orders.select("o_orderkey"), path)
    sinks.empty(v.orders.select("o_orderkey"), path)
    sinks.overwrite(v.orders.select("o_orderkey", "o_custkey"), path)
    return v.spark.read.parquet(path)


query("sink_overwrite", "SELECT o_orderkey, o_custkey FROM orders")(_overwrite)


def _text(v):
    path = session.scratch(v.spark, "text")
    sinks.write_text(v.supplier.select("s_suppkey", "s_name", F.lit("null").alias("x"), "s_nationkey"), path, "mk6")
    from ..sources import files

    return files.text_lines(v.spark, path)


query("sink_text", "SELECT concat(s_suppkey, 'mk6', s_name, 'mk6', 'mk6', s_nationkey) AS value FROM supplier")(_text)


def _csv(v):
    from ..sources import files

    path = session.scratch(v.spark, "csv")
    sinks.write_csv(v.nation, path)
    return files.csv_text(v.spark, path)


query("sink_csv", "SELECT cast(n_nationkey AS varchar) AS n_nationkey, n_name, cast(n_regionkey AS varchar) AS n_regionkey FROM nation")(_csv)


def _src_csv(v):
    from ..sources import files

    path = session.scratch(v.spark, "csv")
    v.part.select("p_partkey", F.concat(F.lit('a "quoted", '), "p_name").alias("p_name"), "p_brand").write.csv(path, header=True, quote='"', escape='"')
    return files.csv_text(v.spark, path)


query("src_csv", """SELECT cast(p_partkey AS varchar) AS p_partkey, concat('a "quoted", ', p_name) AS p_name, p_brand FROM part""")(_src_csv)


def _src_arity(v):
    from ..sources import files

    path = session.scratch(v.spark, "csv")
    v.part.select(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_brand", F.when(F.col("p_size") > 25, F.col("p_type")),
                              F.when(F.col("p_size") > 45, F.lit("extra"))).alias("value")).write.text(path)
    return files.csv_exact(v.spark, path, ["id", "brand", "type"], header=False)


query("src_csv_arity", "SELECT cast(p_partkey AS varchar) AS id, p_brand AS brand, p_type AS type FROM part WHERE p_size > 25 AND p_size <= 45")(_src_arity)
