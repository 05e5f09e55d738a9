"""Insured headcounts by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .premium import step_days


def _spans(insured: DataFrame) -> DataFrame:
    return insured.select(
        "policy_id", "insured_cert_no", S.day("insured_start_date").alias("first"), S.day("insured_end_date").alias("last")
    ).where(F.col("first") <= F.col("last"))


def disjoint_spans(insured: DataFrame, since=None, until=None, policies: DataFrame | None = None) -> DataFrame:
    """Spans of a person under a policy, cut so that no day is covered twice.

    Each span keeps the days after everything that started before it. Equal
    spans are merged first, which bounds a (policy, person) group by its
    calendar days and not by its copies.
    """
    w = Window.partitionBy("policy_id", "insured_cert_no").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    spans = _spans(insured)
    if since is not None:
        spans = spans.select(
            "policy_id", "insured_cert_no", F.greatest(F.col("first"), since).alias("first"), F.least(F.col("last"), until).alias("last")
        ).where(F.col("first") <= F.col("last"))
    spans = spans.distinct()
    if policies is not None:
        # the explicit repartition keeps the persons of a large policy apart after a join on the policy
        spans = spans.join(policies, "policy_id", "left_semi").repartition("policy_id", "insured_cert_no")
    cut = spans.withColumn("covered", F.max("last").over(w))
    return cut.select(
        "policy_id", "insured_cert_no", F.greatest(F.col("first"), F.date_add("covered", 1)).alias("first"), "last"
    ).where(F.col("first") <= F.col("last"))


def headcount_steps(
    policy: DataFrame, insured: DataFrame, product_codes: DataFrame | None = None, since: str | None = None, until: str | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Distinct persons covered per policy as steps: from ``first`` to ``last`` the headcount is ``n``.

    Steps fill the whole policy term, with 0 when nobody is covered. The bounds of
    a policy and the bounds of its persons' spans are change points of one running
    count. ``since`` and ``until`` cut policies and spans first, ``carry`` names
    policy columns to keep.
    """
    pol = policy.where(F.col("policy_code").isNotNull())
    if product_codes is not None:
        pol = pol.join(product_codes.select("product_code").distinct(), F.col("insure_code") == F.col("product_code"), "left_semi")
    lo, hi = F.lit(since).cast("date"), F.lit(until).cast("date")
    pol = pol.select(
        "policy_id",
        F.struct("policy_code", *carry).alias("p"),
        F.greatest(S.day("start_date"), lo).alias("start"),  # greatest and least skip a missing bound
        F.least(S.day("end_date"), hi).alias("end"),
    ).where(F.col("start") <= F.col("end"))
    spans = disjoint_spans(insured, lo, hi, pol.select("policy_id"))

    def point(day, n, inside, p):
        return F.struct(day.alias("day"), F.lit(n).alias("n"), F.lit(inside).alias("inside"), p.alias("p"))

    none = F.lit(None).cast(pol.schema["p"].dataType)
    people = spans.select("policy_id", F.explode(F.array(point(F.col("first"), 1, 0, none), point(F.date_add("last", 1), -1, 0, none))).alias("c"))
    bounds = pol.select("policy_id", F.explode(F.array(point(F.col("start"), 0, 1, F.col("p")), point(F.date_add("end", 1), 0, -1, none))).alias("c"))
    per_day = (
        people.unionByName(bounds)
        .select("policy_id", "c.*")
        .groupBy("policy_id", "day")
        .agg(F.sum("n").alias("n"), F.sum("inside").alias("inside"), F.max("p").alias("p"))
    )
    w = Window.partitionBy("policy_id").orderBy("day")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    steps = per_day.select(
        "policy_id", "day", F.sum("n").over(run).alias("n"), F.sum("inside").over(run).alias("inside"), F.max("p").over(run).alias("p"),
        F.date_sub(F.lead("day").over(w), 1).alias("last"),
    ).where(F.col("inside") > 0)
    return steps.select("policy_id", *[F.col(f"p.{c}").alias(c) for c in ("policy_code", *carry)], F.col("day").alias("first"), "last", "n")


def daily_headcount(policy: DataFrame, insured: DataFrame, product_codes: DataFrame | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """Distinct persons covered on every day of every policy; days are expanded after the last shuffle."""
    steps = headcount_steps(policy, insured, product_codes, since, until)
    days = steps.select("policy_id", "policy_code", "n", F.explode(S.days("first", "last")).alias("day"))
    return days.select("policy_id", "policy_code", S.day_id("day").alias("day_id"), F.col("n").alias("curr_insured"))


def daily_headcount_by_ent(policy: DataFrame, insured: DataFrame, product_codes: DataFrame | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """Headcount per enterprise and day, summed step by step: policy-days are never expanded."""
    steps = headcount_steps(policy.where(S.not_blank("ent_id")), insured, product_codes, since, until, carry=("ent_id",))
    sums = step_days(steps, "ent_id", {"curr_insured": "n"})
    return sums.select("ent_id", S.day_id("day").alias("day_id"), "curr_insured")


def headcount_on(policy: DataFrame, insured: DataFrame, as_of: str, product_codes: DataFrame | None = None) -> DataFrame:
    """The daily snapshot of one day only: no day expansion at all."""
    today = F.lit(as_of).cast("date")
    pol = policy.where(F.col("policy_code").isNotNull() & (S.day("start_date") <= today) & (S.day("end_date") >= today))
    if product_codes is not None:
        pol = pol.join(product_codes.select("product_code").distinct(), F.col("insure_code") == F.col("product_code"), "left_semi")
    n = (
        _spans(insured)
        .where((F.col("first") <= today) & (F.col("last") >= today))
        .select("policy_id", "insured_cert_no")
        .distinct()
        .groupBy("policy_id")
        .agg(F.count("*").alias("n"))
    )
    return pol.join(n, "policy_id", "left").select(
        "policy_id", "policy_code", F.lit(as_of.replace("-", "")).alias("day_id"), F.coalesce("n", F.lit(0)).alias("curr_insured")
    )


def current_headcount(policy, channel, product, snapshot, as_of: str, statuses=None) -> DataFrame:
    """Today's headcount of every channel member; members without policies count 0."""
    today = as_of.replace("-", "")
    ok = S.valid_policy() if statuses is None else F.col("policy_status").isin(*statuses)
    pol = (
        policy.where(ok)
        .join(product.select("product_code").distinct(), F.col("insure_code") == F.col("product_code"), "left_semi")
        .select(F.trim("holder_company").alias("name"), "policy_id")
    )
    now = snapshot.where(F.col("day_id") == today).select("policy_id", "curr_insured")
    names = channel.select("ent_id", F.trim("ent_name").alias("name"))
    return (
        names.join(pol, "name", "left")
        .join(now, "policy_id", "left")
        .groupBy("ent_id")
        .agg(F.sum(F.coalesce("curr_insured", F.lit(0))).alias("cur_insured_persons"))
        .select("ent_id", F.lit(today[:6]).alias("month_id"), "cur_insured_persons")
    )


def headcount_ent_day(policy, daily) -> DataFrame:
    """Headcount per enterprise and day from a stored daily table."""
    own = policy.where(S.not_blank("ent_id")).select("policy_id", "ent_id")
    return daily.join(own, "policy_id").groupBy("ent_id", "day_id").agg(F.sum("curr_insured").alias("curr_insured"))


def headcount_month_peak(ent_day: DataFrame, as_of: str) -> DataFrame:
    """Highest daily headcount of the newest month up to a date."""
    peak = (
        ent_day.where(F.col("day_id") <= as_of.replace("-", ""))
        .groupBy("ent_id", F.substring("day_id", 1, 6).alias("month_id"))
        .agg(F.max("curr_insured").alias("peak"))
    )
    return peak.groupBy("ent_id").agg(F.max("month_id").alias("month_id"), F.max_by("peak", "month_id").alias("peak"))
