"""Labels of insured persons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S
from .claim import claim_facts


def person_any(policy, insured, work_level) -> DataFrame:
    """One employer name, work risk level and enterprise per person (smallest value for a stable pick)."""
    has_id = S.not_blank("insured_cert_no")
    levels = work_level.where(F.col("ai_level").isNotNull())
    rows = insured.where(has_id).join(levels, F.col("insured_work_type") == F.col("work_type"), "left")
    # one row per (person, policy) before the policy join
    per_policy = rows.groupBy("insured_cert_no", "policy_id").agg(
        F.min(F.when(S.not_blank("insured_company_name"), F.col("insured_company_name"))).alias("user_company"),
        F.min("ai_level").alias("user_craft_level"),
    )
    own = policy.where(S.not_blank("ent_id")).select("policy_id", "ent_id")
    return (
        per_policy.join(own, "policy_id", "left")
        .groupBy("insured_cert_no")
        .agg(
            F.min("user_company").alias("user_company"),
            F.min("user_craft_level").alias("user_craft_level"),
            F.min("ent_id").alias("user_ent_id"),
        )
    )


def person_has_child(insured) -> DataFrame:
    return (
        insured.where((F.length("insured_cert_no") > 4) & (F.length("child_cert_no") > 4))
        .select("insured_cert_no", F.lit(codes.YES).alias("user_child"))
        .distinct()
    )


def person_claims(claims) -> DataFrame:
    """Claim counts per person; absent kinds are 0."""
    facts = claim_facts(claims.where(F.length("cert_no") > 14), "cert_no")
    overtime = (
        claims.where((F.col("overtime") == codes.YES) & (F.length("cert_no") > 14)).groupBy("cert_no").agg(F.count("*").alias("o"))
    )
    return facts.join(overtime, "cert_no", "left").select(
        "cert_no",
        F.col("claims").alias("user_report_num"),
        F.col("closed").alias("claim_count"),
        F.col("deaths").alias("death_count"),
        F.col("disabilities").alias("disable_count"),
        F.col("at_work").alias("worktime_count"),
        F.col("off_work").alias("nonworktime_count"),
        F.coalesce("o", F.lit(0)).alias("overtime_count"),
    )


def person_short_risk(risk_period, short: int = 3) -> DataFrame:
    return (
        risk_period.where(S.not_blank("cert_no") & (F.col("risk_period") < short))
        .groupBy("cert_no")
        .agg(F.count("*").alias("user_aging_risk"))
    )


def person_coverage(policy, insured) -> DataFrame:
    """Largest coverage of a person's policies, compared as numbers."""
    pairs = insured.where(F.length("insured_cert_no") == 18).select("policy_id", "insured_cert_no").distinct()
    cover = policy.select("policy_id", F.col("sku_coverage").try_cast("bigint").alias("c"))
    return pairs.join(cover, "policy_id").groupBy("insured_cert_no").agg(F.max("c").alias("official_website_coverage"))


def coverage_with_rides(policy, insured, rides) -> DataFrame:
    """Person coverage united with the fixed coverage of ride editions, the largest per person."""
    edition = F.col("product_code")
    ride = F.coalesce(*[F.when(edition == k, F.lit(int(v))) for k, (_, v) in codes.RIDE_EDITIONS.items()])
    from_rides = rides.select(F.col("insured_cert_no"), ride.cast("bigint").alias("c")).where(F.col("c").isNotNull())
    from_policy = person_coverage(policy, insured).select("insured_cert_no", F.col("official_website_coverage").alias("c"))
    return from_policy.unionByName(from_rides).groupBy("insured_cert_no").agg(F.max("c").alias("user_insure_coverage"))


def person_policy_count(policy, insured) -> DataFrame:
    """Person rows under valid policies."""
    ok = policy.where(S.valid_policy()).select("policy_id")
    per = insured.where(S.not_blank("insured_cert_no")).groupBy("policy_id", "insured_cert_no").agg(F.count("*").alias("n"))
    return per.join(ok, "policy_id").groupBy("insured_cert_no").agg(F.sum("n").alias("policy_count"))


def person_payout(claims) -> DataFrame:
    """Expected payouts by kind and paid total per person, cut to whole units."""
    case, scene = F.col("case_type"), F.col("scene")
    rows = claims.where(F.length("cert_no") > 14)
    pre = S.clean_amount("pre_com")
    paid = S.clean_amount("final_payment")

    def whole(cond=None):
        return F.sum(pre if cond is None else F.when(cond, pre)).cast("bigint")

    return rows.groupBy(F.trim("cert_no").alias("cert_no")).agg(
        whole().alias("prepay_total"),
        whole(case == codes.DEATH).alias("prepay_death"),
        whole(case == codes.DISABILITY).alias("prepay_disable"),
        whole(scene == codes.AT_WORK).alias("prepay_worktime"),
        whole(scene.isin(*codes.OFF_WORK)).alias("prepay_nonworktime"),
        F.sum(paid).cast("bigint").alias("finalpay_total"),
    )


def person_payout_avg(claims, digits: int | None = 2) -> DataFrame:
    """Mean expected and paid amounts and mean time effect, rounded half-even.

    Rows with Chinese text in the amount are left out altogether; other dirty
    amounts are missing from the sum but counted in the divisor.
    """
    rows = claims.where(F.length("cert_no") > 2)

    def shown(x):
        return x if digits is None else F.bround(x, digits)

    def mean(c: str):
        usable = ~F.coalesce(S.has_chinese(c), F.lit(False))
        return shown(S.ratio(F.sum(F.when(usable, S.clean_amount(c))), F.count(F.when(usable, 1))))

    te = F.col("time_effect")
    kept = te != "(43304)"
    # a NULL time effect does not pass the inequality and is left out
    effect = F.avg(F.when(kept, F.coalesce(F.nullif(te, F.lit("")), F.lit("0")).try_cast("double")))
    return rows.groupBy("cert_no").agg(
        mean("pre_com").alias("avg_prepay"), mean("final_payment").alias("avg_finalpay"), shown(effect).alias("avg_effecttime")
    )
