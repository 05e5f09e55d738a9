"""The wide company-plan mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S
from .channel import channel_map


def plan_matrix(
    snapshot, policy, insured, plan, product, salesman, team, place, place_names, claims, charged, work_grade, as_of: str,
    groups=codes.EMPLOYER_GROUPS, repeat_per_join_row: bool = False,
) -> DataFrame:
    """Headcount, payout, earned premium and weighted price per (channel, job class, coverage).

    Claims and accrued premium are summed per policy before they are joined, so a
    policy with several of each is counted once. ``repeat_per_join_row`` gives the
    figures of the row-by-row joins instead, in which every policy repeats per
    claim and accrual day; multiplicities stand in for the repeated rows, and
    ``charged`` must have a row per day (day_id). Else it may have the sum to the date
    per policy (``premium.premium_to_date``).

    ``snapshot`` may be ``standing.policy_standing``, which holds the persons and the premium of a policy as well:
    ``insured`` and ``charged`` are None then, and the person rows have been read once for all three figures.
    """
    today = as_of.replace("-", "")
    pol = (
        policy.where(S.in_force())
        .join(product.where(F.col("dim_1").isin(*groups)).select("product_code"), F.col("insure_code") == F.col("product_code"), "left_semi")
        .select("policy_id", "policy_code", F.trim("holder_company").alias("holder"))
    )
    price = F.when(F.col("sku_charge_type") == "2", F.col("sku_price") / 12).otherwise(F.col("sku_price")).cast("decimal(13,4)")
    plans = plan.select("policy_code", F.col("sku_coverage").alias("sku_coverage"), price.alias("price"))
    current = snapshot.where(F.col("day_id") == today)
    if insured is None:
        current = current.where("running").select("policy_id", "curr_insured", "persons", F.col("charged_premium").alias("earned"), F.lit(1).alias("n_days"))
        more = []
    else:
        current = current.select("policy_id", "curr_insured")
        people = insured.select("policy_id", F.trim("insured_cert_no").alias("c")).distinct().groupBy("policy_id").agg(F.count("*").alias("persons"))
        if "day_id" in charged.columns:
            charged = charged.where(F.col("day_id") <= today)
        more = [people, charged.groupBy("policy_id").agg(F.sum("charged_premium").alias("earned"), F.count("*").alias("n_days"))]
    due = S.clean_amount(F.coalesce(F.trim("final_payment"), F.trim("pre_com")))
    paid = claims.groupBy(F.col("policy_no").alias("policy_code")).agg(F.sum(due).alias("due"), F.count("*").alias("n_claims"))
    sales = channel_map(salesman).select(F.col("ent_name").alias("holder"), "channel", "ent_id").join(
        salesman.select("ent_id", "salesman", "biz_operator").distinct(), "ent_id"
    )
    teams = team.select(F.col("sale_name").alias("salesman"), F.coalesce("team_name", F.lit("公司")).alias("team_name"))
    prov = place_names.select(F.col("code").alias("office_province"), F.col("short_name").alias("province"))
    city = place_names.select(F.col("code").alias("office_city"), F.col("short_name").alias("city"))

    rows = (
        current.join(pol, "policy_id")
        .join(plans, "policy_code", "left")
        .join(sales, "holder", "left")
        .where(F.col("channel").isNotNull())
        .join(teams, "salesman", "left")
        .join(place.select("policy_code", "office_province", "office_city"), "policy_code", "left")
        .join(prov, "office_province", "left")
        .join(city, "office_city", "left")
        .join(paid, "policy_code", "left")
        .join(work_grade, "policy_code", "left")
    )
    for facts in more:
        rows = rows.join(facts, "policy_id", "left")
    nc, nd = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) if repeat_per_join_row else F.lit(1) for c in ("n_claims", "n_days"))
    keys = ["channel", "profession_type", "sku_coverage"]
    n = F.coalesce("persons", F.lit(0))
    p = F.coalesce("price", F.lit(0))
    sums = rows.groupBy(*keys).agg(
        F.min("salesman").alias("salesman"),
        F.min("team_name").alias("team_name"),
        F.min("biz_operator").alias("biz_operator"),
        F.min("province").alias("province"),
        F.min(F.when(F.col("province").isin(*codes.MUNICIPALITIES), F.col("province")).otherwise(F.col("city"))).alias("city"),
        F.sum(F.col("curr_insured") * nc * nd).alias("curr_insured"),
        F.sum(F.coalesce("due", F.lit(0)) * nd).cast("decimal(24,4)").alias("pre_com"),
        F.sum(F.coalesce("earned", F.lit(0)) * nc).cast("decimal(24,4)").alias("charged_premium"),
        F.sum(n).alias("insured_count"),
        F.sum((p * n).cast("decimal(24,4)")).cast("decimal(24,4)").alias("all_premium"),
    )
    return sums.where(F.col("profession_type").isNotNull() & F.col("sku_coverage").isNotNull()).select(
        *keys, "salesman", "team_name", "biz_operator", "province", "city", "curr_insured",
        *[F.col(c).cast("double").alias(c) for c in ("pre_com", "charged_premium")],
        "insured_count",
        F.col("all_premium").cast("double").alias("all_premium"),
        F.when(F.col("insured_count") != 0, F.round(S.ratio("all_premium", "insured_count"), 4)).alias("avg_premium"),
        F.substring("channel", 1, 5).alias("short_name"),
    )
