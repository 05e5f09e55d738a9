"""Enterprise and policy base labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S


def product_set(policy: DataFrame) -> DataFrame:
    return (
        policy.where(S.valid_policy() & S.not_blank("insure_code") & F.col("ent_id").isNotNull())
        .groupBy("ent_id")
        .agg(F.array_join(F.array_sort(F.collect_set("insure_code")), "|").alias("ent_insure_code"))
    )


def gender_counts(policy: DataFrame, insured: DataFrame) -> DataFrame:
    """Person rows and men among them, per enterprise."""
    per_policy = (
        insured.where(F.length("insured_cert_no") == 18)
        .groupBy("policy_id")
        .agg(F.count("*").alias("persons"), F.sum(S.id_is_male("insured_cert_no")).alias("men"))
    )
    own = policy.where(F.col("ent_id").isNotNull()).select("policy_id", "ent_id")
    return per_policy.join(own, "policy_id").groupBy("ent_id").agg(F.sum("persons").alias("persons"), F.sum("men").alias("men"))


def gender_share(policy, insured) -> DataFrame:
    g = gender_counts(policy, insured)
    men = F.round(F.col("men") / F.col("persons") * 100, 2)
    women = F.round((F.col("persons") - F.col("men")) / F.col("persons") * 100, 2)
    return g.select("ent_id", men.alias("men_share"), women.alias("women_share"))


def age_sums(policy, insured_term) -> DataFrame:
    """Sum of completed years at insurance start and the rows behind it."""
    age = S.completed_years("insured_birthday", "insured_start_date")
    per_policy = (
        insured_term.where(F.year(S.day("insured_birthday")) > 1900)
        .groupBy("policy_id")
        .agg(F.sum(age).alias("years"), F.count(age).alias("persons"))
    )
    return (
        per_policy.join(policy.where(S.not_blank("ent_id")).select("policy_id", "ent_id"), "policy_id")
        .groupBy("ent_id")
        .agg(F.sum("years").alias("years"), F.sum("persons").alias("persons"))
    )


def insured_age_avg(policy, insured_term) -> DataFrame:
    return age_sums(policy, insured_term).select("ent_id", F.round(S.ratio("years", "persons"), 4).alias("ent_employee_age"))


def ent_profile(enterprise, cant, city_grade, certificate, sum_level) -> DataFrame:
    """Descriptive labels of an enterprise; code tables are looked up by left joins."""
    prov = cant.select(F.col("code").alias("office_province"), F.col("name").alias("ent_province"))
    city = cant.select(F.col("code").alias("office_city"), F.col("short_name").alias("ent_city"))
    grade = city_grade.select(F.col("city_code").alias("office_city"), F.col("city_grade").alias("ent_city_type"))
    kind = certificate.where(S.not_blank("certificate")).select(
        F.col("id_nub").alias("triangle_status"), F.col("certificate").alias("ent_type")
    )
    size = sum_level.where(S.not_blank("ent_id")).select(F.col("ent_id").alias("id"), "ent_scale", "ent_influence_level")
    return (
        enterprise.where(F.col("id").isNotNull())
        .join(prov, "office_province", "left")
        .join(city, "office_city", "left")
        .join(grade, "office_city", "left")
        .join(kind, "triangle_status", "left")
        .join(size, "id", "left")
        .select(
            F.col("id").alias("ent_id"),
            "ent_name",
            F.substring_index(F.col("first_insure_time").cast("string"), " ", 1).alias("first_insure_time"),
            "ent_province",
            "ent_city",
            "ent_city_type",
            "ent_type",
            "ent_scale",
            "ent_influence_level",
        )
        .distinct()
    )


def ent_names(enterprise, channel) -> DataFrame:
    """Names known for an enterprise from its own table and from the channel table."""
    own = enterprise.where(S.not_blank("ent_name")).select(F.col("id").alias("ent_id"), "ent_name")
    return own.unionByName(channel.select("ent_id", "ent_name")).distinct()


def latest_owner(policy, enterprise) -> DataFrame:
    """Owning enterprise of a policy code: the row with the latest create time."""
    ents = enterprise.select(F.col("id").alias("ent_id"), F.col("create_time"))
    return (
        policy.where(S.not_blank("ent_id"))
        .select("policy_code", "ent_id")
        .join(ents, "ent_id")
        .groupBy("policy_code")
        .agg(F.max_by("ent_id", F.struct("create_time", "ent_id")).alias("policy_ent_id"))
    )


def policy_profile(policy) -> DataFrame:
    long_code = F.length("policy_code") > 4
    return policy.where(long_code).select(
        "policy_code",
        F.when(S.not_blank("insure_code"), F.col("insure_code")).alias("policy_insure_code"),
        S.day("start_date").cast("string").alias("policy_start_date"),
        S.day("end_date").cast("string").alias("policy_end_date"),
        F.coalesce(F.col("premium").cast("string"), F.lit("")).alias("policy_premium"),
        F.col("policy_status").cast("string").alias("policy_status"),
        S.day("policy_update_time").cast("string").alias("policy_update_time"),
    )


def policy_coverage(policy, sku_term) -> DataFrame:
    """Coverage from the first two digits of a term code longer than three."""
    pairs = policy.where(S.not_blank("policy_code")).select("policy_code", "sku_code").distinct()
    term = F.col("term_three").cast("string")
    return (
        pairs.join(sku_term.where(F.length(term) > 3).select("sku_code", term.alias("t")), "sku_code")
        .select("policy_code", F.substring("t", 1, 2).alias("policy_term_three"))
    )


def plan_decode(sku_term) -> DataFrame:
    return sku_term.select(
        "sku_code",
        S.term_part("term_three", "sku_coverage", "term_one").alias("sku_coverage"),
        *[S.term_part("term_three", p).alias(p) for p in ("sku_append", "sku_charge_type", "sku_ratio")],
    )


def in_scope_policies(policy, product, groups=codes.EMPLOYER_GROUPS) -> DataFrame:
    dims = product.where(F.col("dim_1").isin(*groups)).select("product_code")
    return policy.join(dims, F.col("insure_code") == F.col("product_code"), "left_semi")
