"""Person x product facts, one-hot product flags and mobile enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# Product groups and the flag each one sets.
FLAGS = {
    "人力资源": "hr", "体育": "sport", "健康": "health", "场景": "scene", "教育": "education", "雇主": "employer",
    "万能小哥": "omnipotent", "共享单车": "share", "其他场景": "other_scene", "兼职场景": "part_time_scene", "婚礼纪": "wedding",
    "小度众包": "crowdsourcing", "新氧医美": "medical_beauty", "觅跑": "running", "货运": "freight", "青芒果": "green_mango",
    "58速运-客户": "express_customer", "58速运-司机": "express_driver", "ofo": "ofo",
}
FACT = ("insured_name", "insured_cert_no", "insured_mobile", "product_type")


def union_facts(*sources: DataFrame) -> DataFrame:
    """Facts of all sources, '' made NULL, without repetitions."""
    cleaned = [
        s.select(
            "insured_name",
            F.nullif(F.trim("insured_cert_no"), F.lit("")).alias("insured_cert_no"),
            F.nullif(S.squeeze_blanks("insured_mobile"), F.lit("")).alias("insured_mobile"),
            "product_type",
        )
        for s in sources
    ]
    return reduce(DataFrame.unionByName, cleaned).distinct()


def union_shards(*shards: DataFrame) -> DataFrame:
    """One table out of monthly shards whose column order may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shards)


def flags_per(facts: DataFrame, key: str, *more) -> DataFrame:
    """19 product flags per key value in one pass."""
    return facts.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max((F.col("product_type") == k).cast("int")).alias(v) for k, v in FLAGS.items()], *more
    )


def _attach(facts: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    # flags hang on distinct persons, not on every fact row
    people = facts.select("insured_name", "insured_cert_no", "insured_mobile").distinct()
    return people.join(flags, key, "left").select(
        "insured_name", "insured_cert_no", "insured_mobile", *[F.coalesce(v, F.lit(0)).alias(v) for v in FLAGS.values()]
    )


def product_flags_by_id(facts: DataFrame) -> DataFrame:
    return _attach(facts, flags_per(facts, "insured_cert_no"), "insured_cert_no")


def product_flags_by_mobile(facts: DataFrame) -> DataFrame:
    """Flags by mobile; a mobile that carries more than one id gives none. A missing id is no further id."""
    card = F.col("insured_cert_no")
    flags = flags_per(facts, "insured_mobile", F.min(card).alias("a"), F.max(card).alias("b")).where(F.col("a").eqNullSafe(F.col("b"))).drop("a", "b")
    return _attach(facts, flags, "insured_mobile")


def unique_names(people: DataFrame) -> DataFrame:
    """Name per (mobile, id, gender, age) when there is exactly one, else ''."""
    keys = ["insured_mobile", "insured_cert_no", "gender", "age"]
    return people.groupBy(*keys).agg(
        F.when(F.min("insured_name") == F.max("insured_name"), F.min("insured_name")).otherwise("").alias("insured_name")
    )


def mobile_enrich(people: DataFrame, location: DataFrame) -> DataFrame:
    """Persons with the home region of their mobile; unknown mobiles stay."""
    loc = location.select(F.col("mobile").alias("insured_mobile"), "province", "city", "operator").distinct()
    return loc.join(unique_names(people), "insured_mobile", "right").distinct()


def unmatched_mobiles(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("province").isNull()).select("insured_mobile").distinct()


def dedup_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the smallest in the given order. Partial aggregation, no window over copies."""
    rest = [c for c in df.columns if c != key and c not in order]
    row = F.min(F.struct(*order, *rest)).alias("r")
    return df.groupBy(key).agg(row).select(key, *[F.col(f"r.{c}").alias(c) for c in [*order, *rest]])


def latest_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    """The row with the latest time per key, ties by the remaining columns."""
    rest = [c for c in df.columns if c not in (key, time)]
    return df.groupBy(key).agg(F.max(F.struct(time, *rest)).alias("r")).select(key, F.col(f"r.{time}").alias(time), *[F.col(f"r.{c}").alias(c) for c in rest])


def earliest_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (key, time)]
    return df.groupBy(key).agg(F.min(F.struct(time, *rest)).alias("r")).select(key, F.col(f"r.{time}").alias(time), *[F.col(f"r.{c}").alias(c) for c in rest])
