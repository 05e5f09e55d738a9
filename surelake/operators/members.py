"""Member tier of a sales channel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S
from .claim import claim_facts
from .enterprise import streak_lengths

# The tier a channel really gets, by nominal tier and downgrade steps.
REAL_TIER = {
    "partner": ("partner", "diamonds", "gold", "silver"),
    "diamonds": ("diamonds", "gold", "silver", "ordinary"),
    "gold": ("gold", "silver", "ordinary", "ordinary"),
    "silver": ("silver", "ordinary", "ordinary", "ordinary"),
    "ordinary": ("ordinary",),
}


@dataclass(frozen=True)
class TierCuts:
    """Headcount and loss-ratio limits of the tiers."""

    partner: int = 30000
    diamonds: int = 8000
    gold: int = 3000
    silver: int = 1000
    partner_months: int = 9
    diamond_months: int = 6
    rate_high: float = 0.7
    rate_low: float = 0.75


def member_sums(policy, claims, standing, channel, product, as_of: str, casual_group: str = codes.CASUAL_GROUP) -> DataFrame:
    """ent_id, due, earned, persons of every listed channel member, from one pass over its valid policies.

    Policies are matched to members by holder name. ``due``: expected payout of the claims. ``earned``: premium accrued to
    the date, and the whole premium of casual-labour policies once effective. ``persons``: headcount on that date.
    ``standing``: ``standing.policy_standing`` on that date. Members without policies have zeros.
    """
    casual = product.where(F.col("dim_1") == casual_group).select(F.col("product_code").alias("insure_code"), F.lit(True).alias("casual")).distinct()
    due = claim_facts(claims, "policy_no").select(F.col("policy_no").alias("policy_code"), "due")
    whole = F.when(F.col("casual") & (S.day("effect_date") <= F.lit(as_of).cast("date")), F.col("premium").cast("decimal(24,4)"))
    now = standing.select("policy_id", "charged_premium", F.when(F.col("running"), F.col("curr_insured")).alias("curr_insured"))
    per_name = (
        policy.where(S.valid_policy())
        .join(casual, "insure_code", "left")
        .select("policy_id", "policy_code", F.trim("holder_company").alias("name"), whole.alias("whole"))
        .join(now, "policy_id", "left")
        .join(due, "policy_code", "left")
        .groupBy("name")
        .agg(*[F.sum(c).alias(c) for c in ("due", "whole", "charged_premium", "curr_insured")])
    )
    names = channel.select("ent_id", F.trim("ent_name").alias("name")).distinct()

    def known(c: str) -> Column:
        return F.coalesce(c, F.lit(0))

    return (
        names.join(per_name, "name", "left")
        .groupBy("ent_id")
        .agg(
            F.sum(known("due")).cast("decimal(24,4)").alias("due"),
            F.sum(known("whole") + known("charged_premium")).cast("decimal(24,4)").alias("earned"),
            F.sum(known("curr_insured")).alias("persons"),
        )
    )


def member_tier(chan, money, months, people, as_of: str, cuts: TierCuts = TierCuts()) -> DataFrame:
    """Tier per channel.

    ``chan``: ent_id, channel. ``money``: ent_id, due, earned. ``months``: ent_id,
    month_id in force. ``people``: ent_id, month_id, persons.
    """
    own = chan.select("ent_id", "channel")
    per_month = people.join(own, "ent_id").groupBy("channel", "month_id").agg(F.sum("persons").alias("persons"))
    counted = people.select("ent_id").distinct()
    sums = (
        own.join(counted, "ent_id", "left_semi")
        .join(money, "ent_id", "left")
        .groupBy("channel")
        .agg(*[F.sum(F.coalesce(c, F.lit(0)).cast("decimal(24,4)")).cast("double").alias(c) for c in ("due", "earned")])
    )
    mine = months.join(own, "ent_id").select("channel", "month_id").distinct()
    streak = streak_lengths(mine, "channel").withColumnRenamed("last_month", "last")

    n = S.month_number("month_id")
    below = per_month.join(streak, "channel", "left").withColumn("age", F.col("last") - n)
    p = F.col("persons")
    recent = below.groupBy("channel").agg(
        F.count_if((F.col("age") >= 0) & (F.col("age") < cuts.partner_months) & (p < cuts.partner)).alias("weak_partner"),
        F.count_if(
            (F.col("age") >= 0) & (F.col("age") < cuts.diamond_months) & ((p < cuts.diamonds) | (p >= cuts.partner))
        ).alias("weak_diamond"),
        F.max_by("persons", "month_id").alias("peak"), F.max("streak").alias("streak"), F.max("last").alias("last"),
    )
    rows = recent.join(sums, "channel").withColumn("streak", F.coalesce("streak", F.lit(0)))
    rate = F.when(F.col("earned") != 0, F.col("due") / F.nullif("earned", F.lit(0.0)))
    # no earned premium: any payout counts as a loss ratio above one
    for_cut = F.coalesce(rate, F.when(F.col("due") > 0, 1.0).otherwise(0.0))

    def steps(limit):
        return F.when(for_cut >= 1.0, 2).when(for_cut >= limit, 1).otherwise(0)

    peak, m = F.col("peak"), F.col("streak")
    rules = [
        ((m >= cuts.partner_months) & (F.col("weak_partner") == 0), "partner", steps(cuts.rate_high)),
        (peak >= cuts.partner, "partner", F.lit(3)),
        ((m >= cuts.diamond_months) & (F.col("weak_diamond") == 0), "diamonds", steps(cuts.rate_high)),
        (peak >= cuts.diamonds, "diamonds", F.lit(3)),
        (peak >= cuts.gold, "gold", steps(cuts.rate_low)),
        (peak >= cuts.silver, "silver", steps(cuts.rate_low)),
        (peak > 0, "ordinary", F.lit(0)),
    ]
    tier, down = None, None
    for cond, name, d in rules:
        tier = F.when(cond, name) if tier is None else tier.when(cond, name)
        down = F.when(cond, d) if down is None else down.when(cond, d)
    now = int(as_of[:4]) * 12 + int(as_of[5:7])
    covers_now = (F.col("last") >= now) & (F.col("last") - F.col("streak") < now)
    out = rows.where(covers_now & (peak > 0)).select(
        "channel", rate.alias("rate"), "due", "earned", tier.alias("tier"), down.alias("downgrade"), "peak", "streak"
    )
    real = F.coalesce(
        *[
            F.when(F.col("tier") == t, F.element_at(F.array(*[F.lit(x) for x in names]), F.least(F.col("downgrade"), F.lit(len(names) - 1)) + 1))
            for t, names in REAL_TIER.items()
        ]
    )
    return out.withColumn("real_tier", real)
