"""Roll-up of enterprise labels to sales channels.

A channel owns enterprises; a direct enterprise is its own channel. Additive
labels of any number are rolled up in one pass over long label rows, ratios are
ratios of summed facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S
from . import claim
from . import enterprise as ent


def channel_map(salesman: DataFrame) -> DataFrame:
    """ent_id, ent_name, channel from the sales table; direct customers stand for themselves."""
    name = F.trim("ent_name")
    return salesman.select(
        "ent_id",
        name.alias("ent_name"),
        F.when(F.col("channel_name") == codes.DIRECT, name).otherwise(F.trim("channel_name")).alias("channel"),
    ).distinct()


def triples(wide: DataFrame, key: str, family: str, labels: list[str] | None = None) -> DataFrame:
    """Wide label row -> ``entity_id, family, label, value, num``; missing labels give no row."""
    names = labels or [c for c in wide.columns if c != key]
    pairs = F.array(
        *[
            F.struct(
                F.lit(n).alias("label"), F.col(n).cast("string").alias("value"), F.col(n).cast("string").try_cast("double").alias("num")
            )
            for n in names
        ]
    )
    return (
        wide.select(F.col(key).cast("string").alias("entity_id"), F.lit(family).alias("family"), F.explode(pairs).alias("t"))
        .select("entity_id", "family", "t.label", "t.value", "t.num")
        .where(F.col("value").isNotNull())
    )


def _members(labels: DataFrame, chan: DataFrame) -> DataFrame:
    return labels.join(chan.select(F.col("ent_id").alias("entity_id"), "channel"), "entity_id")


def roll_sum(labels: DataFrame, chan: DataFrame) -> DataFrame:
    return _members(labels, chan).groupBy("channel", "label").agg(F.sum("num").alias("num"))


def roll_max(labels: DataFrame, chan: DataFrame) -> DataFrame:
    return _members(labels, chan).groupBy("channel", "label").agg(F.max("num").alias("num"))


def roll_set(labels: DataFrame, chan: DataFrame, sep: str) -> DataFrame:
    """Union of the elements of a glued list; elements are de-duplicated before they are gathered."""
    parts = (
        _members(labels, chan)
        .select("channel", "label", F.explode(F.split("value", f"\\Q{sep}\\E")).alias("e"))
        .where(F.col("e") != "")
        .distinct()
    )
    return parts.groupBy("channel", "label").agg(F.array_join(F.array_sort(F.collect_list("e")), sep).alias("value"))


def roll_best(labels: DataFrame, chan: DataFrame) -> DataFrame:
    """The ``name|number`` with the largest number, ties by text."""
    number = F.substring_index("value", "|", -1).try_cast("double")
    return (
        _members(labels, chan)
        .groupBy("channel", "label")
        .agg(F.min_by("value", F.struct(-number, F.col("value"))).alias("value"))
    )


def members(labels: DataFrame, chan: DataFrame, channel: str | None = None) -> DataFrame:
    """Label rows of the enterprises a channel (or any channel) lists."""
    ids = chan if channel is None else chan.where(F.col("channel") == channel)
    return labels.join(ids.select(F.col("ent_id").alias("entity_id")), "entity_id", "left_semi")


def channel_facts(chan, policy, insured, endorse, summary, sum_level, claims) -> DataFrame:
    """Summed facts behind every channel ratio, one row per channel; each table is read once.

    ``insured`` has birthdays and first days of insurance too, ``claims`` the risk period.
    """
    people = summary.where(F.col("data_type") == "totalInsuredPersons")
    monthly = people.groupBy("ent_id").agg(
        F.count("*").alias("months"), F.sum(F.col("data_val").try_cast("bigint")).alias("month_persons")
    )
    parts = [
        ent.policy_totals(policy).select("ent_id", "total_premium"),
        monthly,
        ent.regulation_times(policy, endorse),
        ent.people_facts(policy, insured).select(
            "ent_id", "active", "total_insured_count", "total_insured_persons", "gender_n", "men", "years", "age_n"
        ),
        ent.enterprise_size(sum_level),
        claim.ent_claim_facts(claims, policy),
    ]
    out = chan.select("ent_id", "channel")
    for p in parts:
        out = out.join(p, "ent_id", "left")
    facts = [c for c in out.columns if c not in ("ent_id", "channel")]
    return out.groupBy("channel").agg(*[F.sum(c).alias(c) for c in facts])


def channel_ratios(facts: DataFrame) -> DataFrame:
    r = S.ratio

    def r4(n, d):
        return F.round(r(n, d), 4)

    return facts.select(
        "channel",
        r("total_premium", "months").alias("avg_month_premium"),
        (r("total_premium", "months") * 12).alias("avg_year_premium"),
        r("total_premium", "total_insured_persons").alias("avg_person_premium"),
        F.round(r("active", "ent_scale") * 100, 2).alias("insured_rate"),
        F.floor(r("month_persons", "months")).alias("ent_month_plc_persons"),
        F.ceil(r("ent_add_regulation_times", "months")).alias("ent_month_regulation_times"),
        r4("years", "age_n").alias("ent_employee_age"),
        F.round(r("men", "gender_n") * 100, 2).alias("men_share"),
        r4(F.col("claims") * 100, "total_insured_count").alias("ent_monthly_risk"),
        F.round(1 - r("resubmitted", "claims"), 4).alias("ent_material_integrity"),
        r4("settle_days", "settle_claims").alias("avg_aging_cps"),
        r4("delay_days", "delay_claims").alias("ent_report_time"),
        r4("ageing_days", "ageing_claims").alias("avg_aging_claim"),
        r4("risk_days", "risk_n").alias("avg_aging_risk"),
        F.when(F.col("risk_short") > 1, r4("risk_short", "risk_n")).alias("mix_period_rate"),
        F.when((F.col("deaths") > 0) & (F.col("disabilities") > 0), r4(F.col("deaths") + F.col("disabilities"), "claims")).alias(
            "largecase_rate"
        ),
    )


def channel_profile(profile: DataFrame, chan: DataFrame) -> DataFrame:
    """Descriptive labels of the enterprise whose name equals the channel."""
    return (
        chan.select("channel")
        .distinct()
        .join(profile.withColumnRenamed("ent_name", "channel"), "channel")
        .select("channel", "ent_type", "first_insure_time", "ent_province", "ent_city", "ent_city_type")
    )


def channel_months(summary: DataFrame, chan: DataFrame) -> DataFrame:
    """Distinct months in force over the enterprises of a channel."""
    live = summary.where((F.col("data_type") == "totalInsuredPersons") & (F.col("data_val").try_cast("bigint") > 0))
    return live.select("ent_id", "month_id").join(chan.select("ent_id", "channel"), "ent_id").select("channel", "month_id").distinct()


def channel_streak(summary: DataFrame, chan: DataFrame) -> DataFrame:
    return ent.streak_lengths(channel_months(summary, chan), "channel")
