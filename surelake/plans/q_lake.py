"""Bucketed tables and day folders."""

import uuid

from pyspark.sql import functions as F

from .. import session
from ..sources import lake
from .catalog import query
from .views import EVENT_AS_OF


def _bucketed(v):
    claims = v.claims.select(F.regexp_extract("policy_no", "([0-9]+)$", 1).cast("bigint").alias("policy_id"))
    frames = {"policy": v.policy.select("policy_id"), "insured": v.insured.select("policy_id", "insured_cert_no"), "claims": claims}
    buckets = max(8, session.shares(v.spark, v.folder))  # a task reads whole buckets
    tables = [lake.write_bucketed(d, session.scratch(v.spark, n), f"{n}_{uuid.uuid4().hex}", "policy_id", buckets) for n, d in frames.items()]
    return lake.policy_counts(*tables)


query("policy_counts_bucketed", """
SELECT policy_id, coalesce(persons, 0) AS persons, coalesce(n, 0) AS "rows", coalesce(claims, 0) AS claims FROM policy
LEFT JOIN (SELECT policy_id, count(DISTINCT insured_cert_no) AS persons, count(*) AS n FROM insured GROUP BY 1) USING (policy_id)
LEFT JOIN (SELECT cast(substr(policy_no, 4) AS bigint) AS policy_id, count(*) AS claims FROM claims GROUP BY 1) USING (policy_id)""")(_bucketed)


def _newest(v):
    path, as_of = session.scratch(v.spark, "days"), EVENT_AS_OF.replace("-", "")
    facts = v.events.select("event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("day_id"))
    lake.write_days(facts, path)
    calendar = session.materialise(facts.select("day_id").distinct(), "calendar")
    return lake.on_newest_day(lake.read_days(v.spark, path, facts.schema), calendar, as_of)


query("facts_newest_day", f"""
WITH e AS (SELECT event_id, event_type, strftime(ts, '%Y%m%d') AS day_id FROM events)
SELECT * FROM e WHERE day_id = (SELECT max(day_id) FROM e WHERE day_id <= '{EVENT_AS_OF.replace('-', '')}')""")(_newest)
