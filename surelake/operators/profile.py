"""Person profiles, rider behaviour, id-card features and sport categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S

# Keyword in a product name, sport and label. Checked in this order.
SPORTS = [
    ("羽毛球", "羽毛球", "user_badminton"), ("游泳", "游泳", "user_swimming"), ("雪", "滑雪", "user_skiing"),
    ("铁人三项", "铁人三项", "user_triathlon"), ("爱上水", "水上娱乐", "user_water_entertainment"), ("赛", "赛事", "user_competition"),
    ("马拉松", "马拉松", "user_marathon"), ("跑步", "马拉松", "user_marathon"), ("滑冰", "滑冰", "user_skating"), ("球类", "球类", "user_footwear"),
]


def id_card_features(people: DataFrame, as_of: str, key: str = "insured_cert_no") -> DataFrame:
    """Gender, birth year, age, region codes and constellation key of plausible 18-character cards."""
    c = F.col(key)
    return people.where(S.id_card_plausible(key)).select(key).distinct().select(
        key,
        S.id_gender(c).alias("gender"),
        S.id_birth_year(c).alias("birth_year"),
        (F.lit(int(as_of[:4])) - S.id_birth_year(c)).alias("age"),
        S.id_region(c, "province").alias("province_code"),
        S.id_region(c, "city").alias("city_code"),
        S.id_region(c, "county").alias("county_code"),
        S.id_constellation_key(c).alias("constellation_key"),
    )


def with_regions(features: DataFrame, regions: DataFrame, grades: DataFrame, signs: DataFrame, default: str = "0") -> DataFrame:
    """Names for the codes of ``id_card_features``; ``regions``: code, name; ``grades``: code, grade; ``signs``: key, name."""
    out = features
    for level in ("province", "city", "county"):
        dim = regions.select(F.col("code").alias(f"{level}_code"), F.col("name").alias(level))
        out = out.join(dim, f"{level}_code", "left").withColumn(level, F.coalesce(level, F.lit(default)))
    out = out.join(grades.select(F.col("code").alias("city_code"), "grade"), "city_code", "left")
    out = out.join(signs.select(F.col("key").alias("constellation_key"), F.col("name").alias("constellation")), "constellation_key", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(default)) for c in ("grade", "constellation")})


def profile_person(sources: DataFrame, as_of: str) -> DataFrame:
    """Profile from the united sources.

    ``sources``: cert, mobile, create_time, end_time, product_code, customer_name,
    identity, insured_name. Latest row gives the current facts, earliest row the
    first ones. Equal rows of a person count once.
    """
    ok = sources.where(S.id_card_plausible("cert") & F.col("create_time").isNotNull()).distinct()

    def at(fn, *cols):
        return fn(F.struct("create_time", *cols, *[c for c in ("end_time", "identity", "product_code", "customer_name", "insured_name") if c not in cols]))

    g = ok.groupBy("cert").agg(
        at(F.max).alias("new"),
        at(F.min).alias("old"),
        F.array_join(F.array_sort(F.collect_set("product_code")), "|").alias("user_insure_code"),
        F.count("*").alias("user_insure_product_num"),
    )
    null = F.lit("null")

    def text(c: Column) -> Column:
        return F.coalesce(F.nullif(c.cast("string"), F.lit("")), null)

    return g.select(
        "cert",
        S.id_gender("cert").alias("gender"),
        (F.lit(int(as_of[:4])) - S.id_birth_year("cert")).alias("age"),
        text(F.col("new.insured_name")).alias("insured_name"),
        text(S.day(F.col("new.create_time"))).alias("end_data"),
        text(S.day(F.col("new.end_time"))).alias("b_x_date"),
        text(F.col("new.identity")).alias("social_identity"),
        S.whole_months(F.col("old.create_time"), F.lit(as_of)).alias("insure_to_month"),
        text(F.col("old.product_code")).alias("insurance_products"),
        text(F.col("old.customer_name")).alias("customer_source"),
        text(S.day(F.col("old.create_time"))).alias("start_date"),
        "user_insure_code",
        "user_insure_product_num",
    )


def profile_json(profile: DataFrame) -> DataFrame:
    """The nested JSON document of a profile."""
    # Key names of the document, spelt as its readers expect them.
    return profile.select(
        "cert",
        F.to_json(
            F.struct(
                F.struct(F.concat_ws(",", "insured_name", "age", "gender").alias("user_information"), "end_data", "b_x_date",
                         F.col("social_identity").alias("social_Identity")).alias("personal_Information"),
                F.struct(F.col("insure_to_month").cast("string").alias("Insure_to_month"), F.col("insurance_products").alias("insurance_Products"),
                         F.col("customer_source").alias("customer_Source"), "start_date").alias("fist_now_month_and_product"),
                F.struct("user_insure_code", F.col("user_insure_product_num").cast("string").alias("user_insure_product_num")).alias("user_insure_code_num"),
            )
        ).alias("user_person_none_ofo"),
    )


def ride_facts(rides: DataFrame, as_of: str | None = None) -> DataFrame:
    """Mergeable ride counts per person: one grouped pass, fixed number of counters, the same at any date."""
    start, hour = F.col("start_date"), F.hour("start_date")
    wd = S.iso_weekday("start_date")
    owl = (hour >= 22) | (hour <= 3)
    early = ~owl & (hour <= 7)
    commute = wd.between(1, 5) & hour.between(6, 9)
    product = F.coalesce(F.nullif("product_code", F.lit("")), F.lit("null"))
    return (
        rides.where(S.id_card_plausible("insured_cert_no"))
        .groupBy("insured_cert_no")
        .agg(
            F.count("*").alias("rides"),
            F.count_if(owl).alias("owl"),
            F.count_if(early).alias("early"),
            F.count_if(commute).alias("commute"),
            *[F.count_if(wd == i).alias(f"wd{i}") for i in range(1, 8)],
            F.max(F.struct(start.alias("s"), F.col("end_date").alias("e"))).alias("new"),
            F.min(F.struct(start.alias("s"), product.alias("p"))).alias("old"),
        )
    )


def ride_behaviour(facts: DataFrame, as_of: str, habit: int = 10, commute_habit: int = 3) -> DataFrame:
    """Behaviour labels of a rider from ``ride_facts``; the main weekday is the earliest of the most frequent ones."""
    null = F.lit("null")
    counts = F.array(*[F.col(f"wd{i}") for i in range(1, 8)])
    first = F.col("old.p")
    today = F.lit(as_of).cast("date")
    recent = (S.day(F.col("old.s")) >= F.add_months(today, -3)) & (S.day(F.col("new.s")) <= today)  # then all rides are
    edition = F.coalesce(*[F.when(first == k, F.lit(v[0])) for k, v in codes.RIDE_EDITIONS.items()], null)
    cover = F.coalesce(*[F.when(first == k, F.lit(v[1])) for k, v in codes.RIDE_EDITIONS.items()], null)
    return facts.select(
        "insured_cert_no",
        F.when((F.col("owl") > F.col("early")) & (F.col("owl") >= habit), codes.NIGHT_OWL)
        .when((F.col("early") > F.col("owl")) & (F.col("early") >= habit), codes.EARLY_RISER)
        .otherwise(null)
        .alias("early_night"),
        F.when(F.col("commute") >= commute_habit, codes.COMMUTER).otherwise(null).alias("work"),
        F.array_position(counts, F.array_max(counts)).cast("string").alias("weeks"),
        F.when(recent, F.floor(F.lit(90) / F.col("rides")).cast("string")).otherwise(null).alias("frequency"),
        F.date_format("new.s", "yyyy-MM-dd HH:mm:ss").alias("end_data"),
        F.date_format("new.e", "yyyy-MM-dd HH:mm:ss").alias("b_x_date"),
        F.date_format("old.s", "yyyy-MM-dd HH:mm:ss").alias("start_date"),
        S.whole_months(F.col("old.s"), F.lit(as_of)).alias("insure_to_month"),
        F.col("rides").alias("user_insure_product_num"),
        first.alias("insurance_products"),
        edition.alias("user_type"),
        cover.alias("guarantee"),
    )


def ride_editions(rides: DataFrame) -> DataFrame:
    """Rides per product edition and person."""
    return rides.groupBy("insured_cert_no").agg(
        *[F.count_if(F.col("product_code") == k).alias(n) for k, n in zip(codes.RIDE_EDITIONS, ("campus_rides", "city_rides"))]
    )


def sport_category(policy, insured, product, sports=SPORTS) -> DataFrame:
    """Latest join date per person and sport, sports found by keyword in the product name."""
    name = F.col("product_name")
    hits = F.filter(
        F.array(*[F.when(F.instr(name, kw) > 0, F.struct(F.lit(s).alias("sport"), F.lit(lb).alias("label"))) for kw, s, lb in sports]),
        lambda x: x.isNotNull(),
    )
    kinds = product.where(F.col("product_type_1") == "体育").select("product_code", F.explode(F.array_distinct(hits)).alias("k"))
    pol = policy.where(S.valid_policy()).select("policy_id", "insure_code")
    per = (
        insured.where(F.length("insured_cert_no") == 18)
        .groupBy("policy_id", "insured_cert_no")
        .agg(F.max("insured_create_time").alias("t"))
        .join(pol, "policy_id")
        .groupBy("insure_code", "insured_cert_no")
        .agg(F.max("t").alias("t"))
    )
    return (
        per.join(kinds, F.col("insure_code") == F.col("product_code"))
        .groupBy("insured_cert_no", F.col("k.label").alias("label"), F.col("k.sport").alias("sport"))
        .agg(F.max("t").alias("latest"))
    )
