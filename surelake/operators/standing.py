"""What a policy stands at on a date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .premium import amount, day_price, price_spread


def policy_standing(policy: DataFrame, insured: DataFrame, as_of: str, product_codes: DataFrame | None = None) -> DataFrame:
    """Headcount, earned premium and persons of every policy on a date, from one pass over the person rows.

    One row per policy (policy_id, unique): ``day_id``, ``running`` on that date (policies without a code never are), ``curr_insured`` distinct persons
    covered then, ``charged_premium`` earned up to and including it (null where nothing accrues), ``persons``
    distinct persons ever. Persons are told apart by their trimmed card; all rows without a card count as one. The
    figures equal those of ``headcount.headcount_on`` and ``premium.premium_to_date`` on trimmed cards. The person rows
    are shuffled once, by policy: both groupings keep that partitioning, and adaptive execution splits a large policy.
    """
    today = F.lit(as_of).cast("date")
    pol = policy
    if product_codes is not None:
        pol = pol.join(product_codes.select("product_code").distinct(), F.col("insure_code") == F.col("product_code"), "left_semi")
    start, end = S.day("start_date"), S.day("end_date")
    priced = S.in_force() & F.col("sku_price").isNotNull() & F.col("sku_charge_type").isin("1", "2")
    pol = pol.select(
        "policy_id", F.coalesce(F.col("policy_code").isNotNull() & (start <= today) & (end >= today), F.lit(False)).alias("running"),
        F.when(priced, F.col("sku_price").cast("double")).alias("price"), "sku_charge_type", S.day_count(start, end).alias("policy_days"),
    )
    spans = insured.select(
        "policy_id", F.trim("insured_cert_no").alias("card"), S.day("insured_start_date").alias("first"), S.day("insured_end_date").alias("last"),
        F.lit(1).alias("row"),
    )
    first, last = F.col("first"), F.col("last")
    earned = F.when((first <= last) & (first <= today), amount(S.day_count("first", F.least(last, today))))
    person = (
        pol.join(spans, "policy_id", "left")
        .withColumn("sku_day_price", day_price("price", price_spread()))
        .groupBy("policy_id", "card")
        .agg(
            F.max("running").alias("running"), F.max("row").alias("row"),
            F.max((first <= today) & (last >= today)).alias("covered"), F.sum(earned).cast("decimal(24,4)").alias("earned"),
        )
    )
    return person.groupBy("policy_id").agg(
        F.lit(as_of.replace("-", "")).alias("day_id"), F.max("running").alias("running"),
        F.count_if(F.col("covered") & F.col("running")).alias("curr_insured"),
        F.sum("earned").cast("decimal(24,4)").alias("charged_premium"), F.count("row").alias("persons"),
    )
