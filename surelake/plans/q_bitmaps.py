"""Distinct persons from one stored bitmap table."""

from pyspark.sql import functions as F

from .. import session
from ..operators import bitmaps as BM
from ..operators import channel as CH
from .catalog import query
from .views import AS_OF


def stored(v):
    """The bitmap table, written and read back."""
    home = v.insured.select("policy_id", F.col("insured_cert_no").alias("person")).join(v.policy.select("policy_id", F.col("ent_id").alias("home")), "policy_id")
    numbers = session.materialise(BM.number_persons(home), "numbers")
    path = session.scratch(v.spark, "bitmaps")
    BM.write_bitmaps(BM.person_bitmaps(v.policy, v.insured, v.insured_term.select("insured_id", "insured_start_date"), numbers), path)
    return v.spark.read.parquet(path).withColumn("month_id", F.col("month_id").cast("string"))


_BASE = """
p AS (SELECT policy_id, ent_id, policy_status IN ('0','1','7','9','10') AS valid, policy_status = '1' AS running FROM policy WHERE length(ent_id) > 0),
b AS (SELECT ent_id, insured_cert_no AS c, valid, insure_policy_status = '1' AS live, running, strftime(insured_start_date, '%Y%m') AS month_id
  FROM insured JOIN p USING (policy_id) JOIN (SELECT insured_id, min(insured_start_date) AS insured_start_date FROM insured_term GROUP BY 1) USING (insured_id))"""
_COUNTS = """count(DISTINCT c) FILTER (valid) AS ever, count(DISTINCT c) FILTER (valid AND live) AS active, count(DISTINCT c) FILTER (running AND live) AS now"""

query("bitmap_persons_ent", f"WITH {_BASE} SELECT ent_id, {_COUNTS} FROM b GROUP BY 1")(lambda v: BM.distinct_persons(stored(v), "ent_id"))

query("bitmap_persons_channel", f"""
WITH {_BASE}, m AS (SELECT DISTINCT ent_id, CASE WHEN channel_name = '直客' THEN trim(ent_name) ELSE trim(channel_name) END AS channel FROM channel)
SELECT channel, {_COUNTS} FROM b JOIN m USING (ent_id) GROUP BY 1""")(lambda v: BM.channel_persons(stored(v), CH.channel_map(v.channel)))

# a year and a channel from the months' bitmaps: persons covered anew in several months count once
query("bitmap_persons_year", f"""
WITH {_BASE}, m AS (SELECT DISTINCT ent_id, CASE WHEN channel_name = '直客' THEN trim(ent_name) ELSE trim(channel_name) END AS channel FROM channel)
SELECT channel, substr(month_id, 1, 4) AS year, count(DISTINCT c) FILTER (valid) AS ever FROM b JOIN m USING (ent_id)
WHERE month_id <= '{AS_OF[:4]}{AS_OF[5:7]}' GROUP BY 1, 2""")(
    lambda v: BM.distinct_persons(
        stored(v).where(F.col("month_id") <= AS_OF[:7].replace("-", "")).join(CH.channel_map(v.channel).select("ent_id", "channel").distinct(), "ent_id")
        .withColumn("year", F.substring("month_id", 1, 4)), "channel", "year", measures=("ever",))
)
