"""Enterprise labels on claims.

One grouped pass over the claim table yields the additive facts of every label
per policy; the owning enterprise is joined afterwards and the facts are summed.
A label that only some enterprises have (empty groups have none) is
NULL for the others, and ``label`` drops those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S


#: days below which a risk period is short
SHORT_RISK = 3


def _n(cond):
    return F.count(F.when(cond, 1))


def claim_facts(claims: DataFrame, *keys: str) -> DataFrame:
    """Additive claim facts per key (policy, person, ...); those of risk periods too where the claims have them."""
    case, scene = F.col("case_type"), F.col("scene")
    due = S.payable()
    final = F.col("final_payment")
    risk, report, paper = S.slash_day("risk_date"), S.slash_day("report_date"), S.slash_day("paper_finish_date")
    # greatest skips NULL, so unreadable dates are ruled out first
    readable = (F.length("report_date") > 3) & (F.length("risk_date") > 3) & report.isNotNull() & risk.isNotNull()
    delay = F.when(readable, F.greatest(S.abs_days(report, risk), F.lit(1)))
    ageing = F.when(S.not_blank("paper_finish_date") & (F.length("risk_date") > 3), S.abs_days(paper, risk))
    settle_txt = F.col("finish_days")
    settle = F.when(
        (F.length(settle_txt) > 0) & (F.length(settle_txt) < 10),
        F.when(S.has_chinese(settle_txt), F.lit(0)).when(~settle_txt.contains("="), settle_txt.try_cast("decimal(12,2)")),
    )
    disabled = ~F.col("disable_level").isin(codes.NO_DISABILITY, codes.DEATH)
    period = F.col("risk_period").cast("bigint")
    risks = [F.sum(period).alias("risk_days"), F.count(period).alias("risk_n"), _n(period < SHORT_RISK).alias("risk_short")]
    return claims.groupBy(*keys).agg(
        *(risks if "risk_period" in claims.columns else []),
        F.count("*").alias("claims"),
        _n(S.not_blank("paper_finish_date")).alias("closed"),
        _n(case == codes.DEATH).alias("deaths"),
        _n(case == codes.DISABILITY).alias("disabilities"),
        _n(scene == codes.AT_WORK).alias("at_work"),
        _n(scene.isin(*codes.OFF_WORK)).alias("off_work"),
        _n(F.col("if_resubmit_paper") == codes.YES).alias("resubmitted"),
        # the total leaves out rows whose expected amount is missing or #N/A, even with a final payment
        F.sum(F.when(F.col("pre_com") != "#N/A", due)).alias("due"),
        F.sum(F.when(case == codes.DEATH, due)).alias("due_death"),
        F.sum(F.when(disabled, due)).alias("due_disability"),
        F.sum(F.when(scene == codes.AT_WORK, due)).alias("due_at_work"),
        F.sum(F.when(scene.isin(*codes.OFF_WORK), due)).alias("due_off_work"),
        F.sum(F.when(S.not_blank(final), S.clean_amount(final))).alias("paid"),
        F.sum(delay).alias("delay_days"),
        F.count(delay).alias("delay_claims"),
        F.sum(ageing).alias("ageing_days"),
        F.count(ageing).alias("ageing_claims"),
        F.sum(settle).alias("settle_days"),
        F.count(settle).alias("settle_claims"),
    )


def owners(policy: DataFrame) -> DataFrame:
    return policy.where(S.not_blank("ent_id")).select("policy_code", "ent_id")


def ent_claim_facts(claims: DataFrame, policy: DataFrame) -> DataFrame:
    per_policy = claim_facts(claims, "policy_no")
    own = owners(policy)
    return (
        per_policy.join(own, per_policy.policy_no == own.policy_code)
        .groupBy("ent_id")
        .agg(*[F.sum(c).alias(c) for c in per_policy.columns if c != "policy_no"])
    )


def _some(c: str):
    return F.nullif(F.col(c), F.lit(0))


def _money(c: str):
    return F.round(F.col(c), 2).cast("double")


# label name -> (value from the summed facts, numerator and denominator when it is a ratio)
def _share(n: str, d: str, digits: int = 4):
    return F.round(S.ratio(n, d), digits)


LABELS = {
    "report_num": lambda: _some("claims"),
    "claim_num": lambda: _some("closed"),
    "death_num": lambda: _some("deaths"),
    "disability_num": lambda: _some("disabilities"),
    "worktime_num": lambda: _some("at_work"),
    "nonworktime_num": lambda: _some("off_work"),
    "pre_all_compensation": lambda: _money("due"),
    "pre_death_compensation": lambda: _money("due_death"),
    "pre_dis_compensation": lambda: _money("due_disability"),
    "pre_wt_compensation": lambda: _money("due_at_work"),
    "pre_nwt_compensation": lambda: _money("due_off_work"),
    "all_compensation": lambda: _money("paid"),
    "ent_material_integrity": lambda: F.when(F.col("resubmitted") > 0, F.round(1 - S.ratio("resubmitted", "claims"), 4)),
    "ent_report_time": lambda: _share("delay_days", "delay_claims"),
    "avg_aging_claim": lambda: _share("ageing_days", "ageing_claims"),
    "avg_aging_cps": lambda: _share("settle_days", "settle_claims"),
    "largecase_rate": lambda: F.when(
        (F.col("deaths") > 0) & (F.col("disabilities") > 0),
        F.round(S.ratio(F.col("deaths") + F.col("disabilities"), "claims"), 4),
    ),
}

RISK_LABELS = {
    "avg_aging_risk": lambda: _share("risk_days", "risk_n"),
    "mix_period_count": lambda: _some("risk_short"),
    "mix_period_rate": lambda: F.when(F.col("risk_short") > 1, _share("risk_short", "risk_n")),
}


def claim_labels(claims: DataFrame, policy: DataFrame) -> DataFrame:
    """All labels above as one wide row per enterprise; with those of risk periods where the claims have them."""
    labels = LABELS | (RISK_LABELS if "risk_period" in claims.columns else {})
    return ent_claim_facts(claims, policy).select("ent_id", *[f().alias(k) for k, f in labels.items()])


def label(claims: DataFrame, policy: DataFrame, name: str, keep_empty: bool = False) -> DataFrame:
    """One label; Catalyst prunes the facts it does not need."""
    out = claim_labels(claims, policy).select("ent_id", name)
    return out if keep_empty else out.where(F.col(name).isNotNull())


def payout_expected_of_members(claims: DataFrame, policy: DataFrame, channel: DataFrame, in_scope: DataFrame | None = None) -> DataFrame:
    """Expected payout of the listed channel members; members without claims get 0.

    Policies are matched to members by holder name, as the channel table lists names.
    """
    pol = policy.where(S.valid_policy()) if in_scope is None else policy.where(S.valid_policy()).join(
        in_scope.select("product_code").distinct(), F.col("insure_code") == F.col("product_code"), "left_semi"
    )
    members = channel.select(F.trim("ent_name").alias("name"), F.col("ent_id").alias("member")).distinct()
    due = claim_facts(claims, "policy_no").select("policy_no", "due")
    rows = members.join(pol.select(F.trim("holder_company").alias("name"), "policy_code"), "name")
    return (
        rows.join(due, rows.policy_code == due.policy_no, "left")
        .groupBy(F.col("member").alias("ent_id"))
        .agg(F.sum(F.coalesce("due", F.lit(0))).cast("double").alias("pre_all_compensation"))
    )


def flagged_claims(claims: DataFrame, policy: DataFrame) -> DataFrame:
    """Distinct overtime, refused and withdrawn claims per enterprise in one pass."""
    flags = {
        "overtime_compensation_num": F.col("overtime") == codes.YES,
        "ent_rejected_count": F.col("status") == codes.REJECTED,
        "ent_withdrawn_count": F.col("status") == codes.WITHDRAWN,
    }
    own = owners(policy)
    any_flag = F.lit(False)
    for f in flags.values():
        any_flag = any_flag | F.coalesce(f, F.lit(False))
    per_id = (
        claims.where(any_flag)
        .groupBy("policy_no", "id")
        .agg(*[F.max(F.coalesce(f, F.lit(False)).cast("int")).alias(k) for k, f in flags.items()])
    )
    per_ent = (
        per_id.join(own, per_id.policy_no == own.policy_code).groupBy("ent_id", "id").agg(*[F.max(k).alias(k) for k in flags])
    )
    return per_ent.groupBy("ent_id").agg(*[F.nullif(F.sum(k), F.lit(0)).alias(k) for k in flags])


def flagged(claims, policy, name: str) -> DataFrame:
    return flagged_claims(claims, policy).select("ent_id", name).where(F.col(name).isNotNull())


def claim_rate(claims: DataFrame, policy: DataFrame, insured: DataFrame) -> DataFrame:
    """Claims per hundred insured person-times; enterprises missing either side are absent."""
    from .enterprise import insured_times

    n = ent_claim_facts(claims, policy).select("ent_id", "claims")
    return n.join(insured_times(policy, insured), "ent_id").select(
        "ent_id", F.round(S.ratio(F.col("claims") * 100, "total_insured_count"), 4).alias("ent_monthly_risk")
    )


# --------------------------------------------------------- work risk, removals


def risk_level_headcount(policy, insured, work_level) -> DataFrame:
    """Distinct active persons per enterprise and work risk level."""
    people = (
        insured.where(F.col("insure_policy_status") == "1")
        .select("policy_id", "insured_cert_no", "insured_work_type")
        .join(work_level.where(F.col("ai_level").isNotNull()), F.col("insured_work_type") == F.col("work_type"))
        .select("policy_id", "insured_cert_no", "ai_level")
        .distinct()
    )
    own = policy.where(F.col("ent_id").isNotNull()).select("policy_id", "ent_id")
    return people.join(own, "policy_id").groupBy("ent_id", "ai_level").agg(F.countDistinct("insured_cert_no").alias("persons"))


def risk_level_pivot(policy, insured, work_level) -> DataFrame:
    per_level = risk_level_headcount(policy, insured, work_level)
    return per_level.groupBy("ent_id").agg(
        *[F.max(F.when(F.col("ai_level") == i, F.col("persons"))).alias(f"worktype_{i}_count") for i in range(8)]
    )


def frequent_removals(policy, endorse, more_than: int = 2) -> DataFrame:
    """Distinct persons removed more than ``more_than`` times under one policy."""
    often = (
        endorse.where(F.col("insured_changetype") == codes.REMOVED)
        .groupBy("policy_id", "insured_cert_no")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > more_than)
    )
    own = policy.where(F.col("ent_id").isNotNull()).select("policy_id", "ent_id")
    return often.join(own, "policy_id").groupBy("ent_id").agg(F.countDistinct("insured_cert_no").alias("ent_employee_increase"))


# ---------------------------------------------------------------- risk period


def risk_period_labels(policy, risk_period, short: int = SHORT_RISK) -> DataFrame:
    """Mean risk period, claims with a short one, and their share when there are at least two."""
    days = F.col("risk_period").cast("bigint")
    per_policy = risk_period.groupBy("policy_no").agg(
        F.sum(days).alias("days"), F.count(days).alias("n"), F.count(F.when(days < short, 1)).alias("short")
    )
    own = owners(policy)
    s = (
        per_policy.join(own, per_policy.policy_no == own.policy_code)
        .groupBy("ent_id")
        .agg(*[F.sum(c).alias(c) for c in ("days", "n", "short")])
    )
    return s.select(
        "ent_id",
        F.round(S.ratio("days", "n"), 4).alias("avg_aging_risk"),
        F.nullif("short", F.lit(0)).alias("mix_period_count"),
        F.when(F.col("short") > 1, F.round(S.ratio("short", "n"), 4)).alias("mix_period_rate"),
    )


def risk_period_label(policy, risk_period, name: str) -> DataFrame:
    return risk_period_labels(policy, risk_period).select("ent_id", name).where(F.col(name).isNotNull())


# ------------------------------------------------------------- earned premium


def premium_earned_simple(policy, product, accrued) -> DataFrame:
    """Whole premium of plans not paid yearly, plus what yearly plans have accrued.

    ``accrued``: policy_id, charged_premium up to the day before the date (``premium.premium_to_date``).
    """
    codes_in = product.select("product_code").distinct()
    pol = policy.where(S.valid_policy() & S.not_blank("ent_id")).join(
        codes_in, F.col("insure_code") == F.col("product_code"), "left_semi"
    )
    whole = pol.where(F.col("sku_charge_type") != "2").select("ent_id", F.col("premium").cast("decimal(20,4)").alias("amount"))
    per_policy = accrued.groupBy("policy_id").agg(F.sum("charged_premium").cast("decimal(20,4)").alias("amount"))
    daily = pol.where(F.col("sku_charge_type") == "2").join(per_policy, "policy_id").select("ent_id", "amount")
    return whole.unionByName(daily).groupBy("ent_id").agg(F.sum("amount").cast("double").alias("charged_premium"))


def premium_earned(policy, product, channel, accrued, as_of: str, casual_group: str = codes.CASUAL_GROUP) -> DataFrame:
    """Accrued premium up to the date, plus the whole premium of casual-labour policies once effective.

    ``accrued``: policy_id, charged_premium up to and including the date (``premium.premium_to_date``).
    """
    accrued = accrued.select("policy_id", F.col("charged_premium").cast("decimal(20,4)").alias("amount"))
    pol = policy.where(S.valid_policy())
    casual = (
        pol.join(
            product.where(F.col("dim_1") == casual_group).select("product_code"),
            F.col("insure_code") == F.col("product_code"),
            "left_semi",
        )
        .where(S.day("effect_date") <= F.lit(as_of).cast("date"))
        .select("policy_id", F.col("premium").cast("decimal(20,4)").alias("amount"))
    )
    amounts = accrued.unionByName(casual).groupBy("policy_id").agg(F.sum("amount").alias("amount"))
    names = channel.select(F.trim("ent_name").alias("name"), F.col("ent_id").alias("member")).distinct()
    return (
        pol.select("policy_id", F.trim("holder_company").alias("name"))
        .join(amounts, "policy_id")
        .join(names, "name")
        .groupBy(F.col("member").alias("ent_id"))
        .agg(F.sum("amount").cast("double").alias("charged_premium"))
    )
