"""Enterprise labels on coverage, headcount and premium.

Person and policy rows are first collapsed per policy (map-side), so the join to
the policy table and the roll-up to the enterprise move small rows whatever the
size of a single policy; ``people_facts``, which needs persons apart, counts rows once, behind the join.
The label names are fixed values: they are those of the label store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def _owned(policy: DataFrame, *extra: str) -> DataFrame:
    return policy.where(S.not_blank("ent_id")).select("policy_id", "ent_id", *extra)


def _valid(policy: DataFrame, *extra: str) -> DataFrame:
    return _owned(policy.where(S.valid_policy()), *extra)


# ----------------------------------------------------------- endorsements


def regulation_times(policy: DataFrame, endorse: DataFrame) -> DataFrame:
    """Distinct finished endorsements per enterprise."""
    done = endorse.where(F.col("preserve_status").isin("4", "5")).select("policy_id", "preserve_id").distinct()
    return (
        done.join(_owned(policy), "policy_id")
        .groupBy("ent_id")
        .agg(F.countDistinct("preserve_id").alias("ent_add_regulation_times"))
    )


def summary_months(summary: DataFrame) -> DataFrame:
    """Months with a headcount summary row, per enterprise."""
    return (
        summary.where((F.col("data_type") == "totalInsuredPersons") & S.not_blank("ent_id"))
        .groupBy("ent_id")
        .agg(F.count("month_id").alias("months"))
    )


def regulation_times_monthly(policy: DataFrame, endorse: DataFrame, summary: DataFrame) -> DataFrame:
    """Finished endorsements per summary month, rounded up."""
    return (
        regulation_times(policy, endorse)
        .join(summary_months(summary), "ent_id")
        .select("ent_id", F.ceil(F.col("ent_add_regulation_times") / F.col("months")).alias("ent_month_regulation_times"))
    )


# -------------------------------------------------------- monthly summary


def month_summary_labels(summary: DataFrame, *kinds: str) -> DataFrame:
    """All labels of the monthly summary table in one grouped scan, or those of some row kinds only."""
    if kinds:
        summary = summary.where(F.col("data_type").isin(*kinds))
    val = F.col("data_val").try_cast("bigint")
    kind = F.col("data_type")

    def total(*kinds: str) -> Column:
        return F.sum(F.when(kind.isin(*kinds), val))

    people = kind == "totalInsuredPersons"
    month = F.when(people & (val > 0), F.col("month_id"))
    return (
        summary.where(S.not_blank("ent_id"))
        .groupBy("ent_id")
        .agg(
            total("monAddPersons", "monRenewalPersons").alias("ent_add_sum_persons"),
            total("monSubPersons").alias("ent_del_sum_persons"),
            total("monRenewalPersons").alias("ent_continuous_plc_persons"),
            F.floor(total("totalInsuredPersons") / F.count(F.when(people, 1))).alias("ent_month_plc_persons"),
            F.array_join(F.array_sort(F.collect_set(month)), "-").alias("ent_continuous_plc_month"),
        )
    )


def months_streak(summary: DataFrame) -> DataFrame:
    """Length of the latest unbroken run of months in force (0 when there is none)."""
    people = summary.where((F.col("data_type") == "totalInsuredPersons") & S.not_blank("ent_id"))
    live = people.select("ent_id", F.when(F.col("data_val").try_cast("bigint") > 0, F.col("month_id")).alias("month_id"))
    return streak_lengths(live, "ent_id").withColumnRenamed("streak", "month_number")


def streak_lengths(months: DataFrame, key: str, month: str = "month_id") -> DataFrame:
    """``key, streak, last_month``: latest run of consecutive months; NULL months count as none."""
    rows = months.select(key, S.month_number(month).alias("n")).distinct()
    w = Window.partitionBy(key).orderBy(F.col("n").desc_nulls_last())
    # n + rank is constant inside a run of consecutive months; the latest run holds the first row
    isl = rows.withColumn("island", F.col("n") + F.row_number().over(w))
    runs = isl.groupBy(key, "island").agg(F.count("n").alias("streak"), F.max("n").alias("last"))
    return runs.groupBy(key).agg(
        F.coalesce(F.max_by("streak", "last"), F.lit(0)).alias("streak"), F.max("last").alias("last_month")
    )


def months_since_first(policy: DataFrame, as_of: str) -> DataFrame:
    """30-day months since the first policy was created, at least 1."""
    first = F.min(S.day("policy_create_time"))
    return (
        policy.where(S.valid_policy() & S.not_blank("ent_id"))
        .groupBy("ent_id")
        .agg(first.alias("first"))
        .select("ent_id", F.greatest(F.lit(1), F.floor(F.datediff(F.lit(as_of).cast("date"), "first") / 30)).alias("ent_fist_plc_month"))
    )


# -------------------------------------------------------------- job types


def job_type_count(policy: DataFrame, insured: DataFrame) -> DataFrame:
    kinds = insured.where(S.not_blank("insured_work_type")).select("policy_id", "insured_work_type").distinct()
    return (
        kinds.join(_valid(policy), "policy_id").groupBy("ent_id").agg(F.countDistinct("insured_work_type").alias("ent_insure_craft"))
    )


def _active_jobs(policy: DataFrame, insured: DataFrame, *extra: str) -> DataFrame:
    """Active persons per (policy, job type), joined to the owning enterprise."""
    per_policy = (
        insured.where(F.col("insure_policy_status") == "1").groupBy("policy_id", "insured_work_type").agg(F.count("*").alias("n"))
    )
    return per_policy.join(_owned(policy, *extra), "policy_id")


def _known(jobs: DataFrame, work_level: DataFrame) -> DataFrame:
    levels = work_level.where(F.col("ai_level").isNotNull()).select("work_type", "ai_level")
    return jobs.join(levels, jobs.insured_work_type == levels.work_type)


def job_type_ranked(policy: DataFrame, insured: DataFrame, work_level: DataFrame, top: int = 3) -> DataFrame:
    """The most frequent known job types of active persons, ``rank`` 1 first, ties by name."""
    counts = _known(_active_jobs(policy, insured), work_level).groupBy("ent_id", "work_type").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("ent_id").orderBy(F.col("n").desc(), F.col("work_type"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def job_type_nth(policy, insured, work_level, n: int) -> DataFrame:
    label = {1: "ent_first_craft", 2: "ent_second_craft", 3: "ent_third_craft"}[n]
    return (
        job_type_ranked(policy, insured, work_level, n)
        .where(F.col("rank") == n)
        .select("ent_id", F.concat_ws("|", "work_type", "n").alias(label))
    )


def job_type_max_paid(policy, insured, work_level, claims) -> DataFrame:
    """Job type found under the policy with the single largest final payment."""
    paid = (
        claims.select("policy_no", S.clean_amount("final_payment").alias("paid")).groupBy("policy_no").agg(F.max("paid").alias("paid"))
    ).where(F.col("paid").isNotNull())
    jobs = _known(_active_jobs(policy, insured, "policy_code"), work_level)
    return (
        jobs.join(paid, jobs.policy_code == paid.policy_no)
        .groupBy("ent_id")
        .agg(F.max("paid").alias("paid"), F.min_by("work_type", F.struct(-F.col("paid"), F.col("work_type"))).alias("work_type"))
        .select("ent_id", F.concat_ws("|", "work_type", F.col("paid").cast("decimal(20,2)").cast("string")).alias("ent_most_money_craft"))
    )


def job_type_most_claims(policy, insured, claims) -> DataFrame:
    """Job type with the most (active person, claim) pairs over shared policies."""
    per_policy = claims.groupBy("policy_no").agg(F.count("*").alias("claims"))
    jobs = _active_jobs(policy, insured, "policy_code")
    counts = (
        jobs.join(per_policy, jobs.policy_code == per_policy.policy_no)
        .groupBy("ent_id", "insured_work_type")
        .agg(F.sum(F.col("n") * F.col("claims")).alias("n"))
    )
    return counts.groupBy("ent_id").agg(
        F.min_by(F.concat_ws("|", "insured_work_type", "n"), F.struct(-F.col("n"), F.col("insured_work_type"))).alias(
            "ent_most_count_craft"
        )
    )


# ------------------------------------------------------------- headcounts


def _distinct_people(policy: DataFrame, insured: DataFrame, label: str) -> DataFrame:
    people = insured.select("policy_id", "insured_cert_no").distinct()
    return people.join(policy, "policy_id").groupBy("ent_id").agg(F.countDistinct("insured_cert_no").alias(label))


def people_facts(policy: DataFrame, insured: DataFrame) -> DataFrame:
    """All person counts of an enterprise from one pass over the person rows and one join to the policies.

    ``total_insured_count`` rows and ``total_insured_persons`` persons on valid policies, ``active`` persons in force
    on them, ``cur_insured_persons`` in force on running ones, ``gender_n`` and ``men`` rows with a card,
    ``active_cards`` rows in force with a card on valid policies. A count is null where there is none.
    Where the person rows have birthdays and first days of insurance, also ``years`` and ``age_n``: the completed
    years at the first day and the rows behind them.
    """
    aged = {"insured_birthday", "insured_start_date"} <= set(insured.columns)
    age = F.when(F.year(S.day("insured_birthday")) > 1900, S.completed_years("insured_birthday", "insured_start_date"))
    per = insured.select("policy_id", "insured_cert_no", F.coalesce(F.col("insure_policy_status") == "1", F.lit(False)).alias("live"), *([age.alias("age")] if aged else []))
    named = S.not_blank("ent_id")
    pol = policy.where(F.col("ent_id").isNotNull()).select(
        "policy_id", "ent_id", F.coalesce(S.valid_policy() & named, F.lit(False)).alias("valid"),
        F.coalesce((F.col("policy_status") == "1") & named, F.lit(False)).alias("running"),
    )
    # rows are counted once, under the enterprise: a large policy is split by adaptive execution
    own = S.not_blank("ent_id")
    person = per.join(pol, "policy_id").groupBy("ent_id", "insured_cert_no").agg(
        F.count("*").alias("rows"), F.nullif(F.count_if("valid"), F.lit(0)).alias("n"), F.count_if(F.col("valid") & F.col("live")).alias("live"),
        F.max(F.col("running") & F.col("live")).alias("now"),
        *([F.sum(F.when(own, F.col("age"))).alias("years"), F.count(F.when(own, F.col("age"))).alias("age_n")] if aged else []),
    )
    # what follows from the card, or from other counts, is not shuffled
    known, card = F.col("insured_cert_no").isNotNull(), F.length("insured_cert_no") == 18

    def some(x: Column) -> Column:
        return F.nullif(x, F.lit(0))

    return person.groupBy("ent_id").agg(
        some(F.sum("n")).alias("total_insured_count"), some(F.count_if(known & F.col("n").isNotNull())).alias("total_insured_persons"),
        some(F.count_if(known & (F.col("live") > 0))).alias("active"), some(F.count_if(known & F.col("now"))).alias("cur_insured_persons"),
        some(F.sum(F.when(card, F.col("rows")))).alias("gender_n"), F.sum(F.when(card, S.id_is_male("insured_cert_no") * F.col("rows"))).alias("men"),
        some(F.sum(F.when(card, F.col("live")))).alias("active_cards"),
        *([F.sum("years").alias("years"), some(F.sum("age_n")).alias("age_n")] if aged else []),
    )


def people_labels(policy: DataFrame, insured: DataFrame, sum_level: DataFrame) -> DataFrame:
    """``people_facts`` with the rate and the shortfall against the enterprise's size."""
    number = F.col("ent_scale").try_cast("int")
    size = sum_level.where(S.not_blank("ent_id")).groupBy("ent_id").agg(
        F.max(number).alias("ent_scale"), F.max(F.when(F.length("ent_scale") < 10, number)).alias("short_scale")
    )
    rate = F.when(F.col("ent_scale") > 0, F.round(F.col("active") / F.col("ent_scale") * 100, 2))
    gap = F.when(F.col("short_scale").isNotNull() & F.col("active_cards").isNotNull(), F.greatest(F.col("short_scale") - F.col("active_cards"), F.lit(0)))
    return (
        people_facts(policy, insured)
        .join(size, "ent_id", "left")
        .withColumns({"insured_rate": rate, "ent_potential_scale": gap.cast("bigint")})
        .drop("short_scale")
    )


def insured_times(policy, insured) -> DataFrame:
    per_policy = insured.groupBy("policy_id").agg(F.count("*").alias("n"))
    return per_policy.join(_valid(policy), "policy_id").groupBy("ent_id").agg(F.sum("n").alias("total_insured_count"))


def insured_persons(policy, insured) -> DataFrame:
    return _distinct_people(_valid(policy), insured, "total_insured_persons")


def insured_persons_current(policy, insured) -> DataFrame:
    active = insured.where(F.col("insure_policy_status") == "1")
    return _distinct_people(_owned(policy.where(F.col("policy_status") == "1")), active, "cur_insured_persons")


def enterprise_size(sum_level: DataFrame) -> DataFrame:
    return (
        sum_level.where(S.not_blank("ent_id")).groupBy("ent_id").agg(F.max(F.col("ent_scale").try_cast("int")).alias("ent_scale"))
    )


def insured_rate(policy, insured, sum_level) -> DataFrame:
    """Distinct active persons over enterprise size, in percent."""
    active = insured.where(F.col("insure_policy_status") == "1")
    n = _distinct_people(_valid(policy), active, "n")
    return (
        n.join(enterprise_size(sum_level), "ent_id")
        .where(F.col("ent_scale") > 0)
        .select("ent_id", F.round(F.col("n") / F.col("ent_scale") * 100, 2).alias("insured_rate"))
    )


def potential_headcount(policy, insured, sum_level) -> DataFrame:
    """Largest shortfall of active person rows against enterprise size, never below 0."""
    per_policy = (
        insured.where((F.col("insure_policy_status") == "1") & (F.length("insured_cert_no") == 18))
        .groupBy("policy_id")
        .agg(F.count("*").alias("n"))
    )
    n = per_policy.join(_valid(policy), "policy_id").groupBy("ent_id").agg(F.sum("n").alias("n"))
    size = sum_level.where(S.not_blank("ent_id") & (F.length("ent_scale") < 10)).select(
        "ent_id", F.col("ent_scale").try_cast("int").alias("ent_scale")
    ).where(F.col("ent_scale").isNotNull())
    return (
        size.join(n, "ent_id")
        .groupBy("ent_id")
        .agg(F.max(F.greatest(F.col("ent_scale") - F.col("n"), F.lit(0))).cast("bigint").alias("ent_potential_scale"))
    )


# ---------------------------------------------------------------- premium


def policy_totals(policy: DataFrame) -> DataFrame:
    """Valid policy count and premium per enterprise."""
    return (
        policy.where(S.valid_policy() & S.not_blank("ent_id"))
        .groupBy("ent_id")
        .agg(F.count("*").alias("effective_policy"), F.sum("premium").alias("total_premium"))
    )


def valid_policy_count(policy) -> DataFrame:
    return policy_totals(policy).select("ent_id", "effective_policy")


def premium_total(policy) -> DataFrame:
    return policy_totals(policy).select("ent_id", F.col("total_premium").cast("double").alias("total_premium"))


def premium_month_avg(policy, summary) -> DataFrame:
    return (
        policy_totals(policy)
        .join(summary_months(summary), "ent_id")
        .select("ent_id", S.ratio("total_premium", "months").alias("avg_month_premium"))
    )


def premium_year_avg(policy, summary) -> DataFrame:
    return (
        policy_totals(policy)
        .join(summary_months(summary), "ent_id")
        .select("ent_id", (S.ratio("total_premium", "months") * 12).alias("avg_year_premium"))
    )


def premium_per_person(policy, insured) -> DataFrame:
    return (
        policy_totals(policy)
        .join(insured_persons(policy, insured), "ent_id")
        .select("ent_id", S.ratio("total_premium", "total_insured_persons").alias("avg_person_premium"))
    )


def mode_value(df: DataFrame, key: str, value: str, alias: str = "mode_value") -> DataFrame:
    """Most frequent value per key, ties by value."""
    n = df.groupBy(key, value).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(alias))


# -------------------------------------------------------- all in one table


def insure_labels(policy, insured, endorse, summary, sum_level, work_level, claims, as_of) -> DataFrame:
    """Every coverage label of an enterprise as one wide row."""
    parts = [
        policy_totals(policy),
        month_summary_labels(summary),
        months_streak(summary).select("ent_id", "month_number"),
        months_since_first(policy, as_of),
        regulation_times(policy, endorse),
        regulation_times_monthly(policy, endorse, summary),
        premium_month_avg(policy, summary),
        premium_year_avg(policy, summary),
        job_type_count(policy, insured),
        job_type_ranked(policy, insured, work_level).groupBy("ent_id").agg(
            *[
                F.max(F.when(F.col("rank") == i, F.concat_ws("|", "work_type", "n"))).alias(f"ent_{w}_craft")
                for i, w in ((1, "first"), (2, "second"), (3, "third"))
            ]
        ),
        job_type_max_paid(policy, insured, work_level, claims),
        job_type_most_claims(policy, insured, claims),
        people_labels(policy, insured, sum_level).select(
            "ent_id", "total_insured_count", "total_insured_persons", "cur_insured_persons", "insured_rate", "ent_potential_scale"
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "ent_id", "full")
    return out.withColumn("avg_person_premium", S.ratio("total_premium", "total_insured_persons"))
