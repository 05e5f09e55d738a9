"""Premium accrual by day and its roll-ups.

The per-person-per-day table is only expanded when it is asked for. Sums per
policy and day come from change points (a price enters on the first day and
leaves after the last one), sums to a date or per month from day counts, so
their cost follows the number of spans and not the number of days.
Day prices are exact decimals, which keeps running sums exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

PRICE = "decimal(18,4)"


PERSON = ("insured_id", "insured_cert_no")


def price_spread() -> Column:
    """Days over which a plan spreads its price: the person's own for a monthly one, else the policy's."""
    return F.when(F.col("sku_charge_type") == "1", S.day_count("first", "last")).otherwise(F.col("policy_days"))


def day_price(price: str, days: Column) -> Column:
    return F.bround(F.col(price) / F.nullif(days, F.lit(0)), 4).cast(PRICE)


def accrual_spans(policy, insured, product_codes=None, by_person: bool = False, plan=None) -> DataFrame:
    """In-force person spans with their day price and the number of persons sharing them.

    ``plan`` (policy_code, sku_charge_type, sku_price) may hold several plans per policy, each accrues on
    its own; without it the policy's own price columns are its one plan.

    Monthly plans ('1') spread the price over the person's days, yearly plans
    ('2') over the policy's days, so all equal spans of a policy have the same
    price. They are counted before the policy join, which bounds a policy by its
    days; ``by_person`` keeps one row per person instead.
    """
    if plan is not None:
        policy = policy.drop("sku_charge_type", "sku_price").join(plan.select("policy_code", "sku_charge_type", "sku_price"), "policy_code")
    pol = policy.where(S.in_force() & F.col("sku_price").isNotNull() & F.col("sku_charge_type").isin("1", "2"))
    if product_codes is not None:
        pol = pol.join(product_codes.select("product_code").distinct(), F.col("insure_code") == F.col("product_code"), "left_semi")
    pol = pol.select(
        "policy_id",
        "ent_id",
        "sku_charge_type",
        F.col("sku_price").cast("double").alias("price"),
        S.day_count(S.day("start_date"), S.day("end_date")).alias("policy_days"),
    )
    keys = ("policy_id", *(PERSON if by_person else ()))
    spans = insured.select(*keys, S.day("insured_start_date").alias("first"), S.day("insured_end_date").alias("last")).where(
        F.col("first") <= F.col("last")
    )
    spans = spans.withColumn("persons", F.lit(1)) if by_person else spans.groupBy(*spans.columns).agg(F.count("*").alias("persons"))
    return spans.join(pol, "policy_id").select(
        *keys,
        "ent_id",
        "sku_charge_type",
        "first",
        "last",
        "persons",
        day_price("price", price_spread()).alias("sku_day_price"),
    )


def amount(*factors) -> Column:
    """Day price times whole numbers, exact."""
    x = F.col("sku_day_price")
    for f in factors:
        x = (x * f).cast("decimal(24,4)")
    return x


def premium_daily(policy, insured, product_codes=None, plan=None) -> DataFrame:
    """One row per covered person-day."""
    keep = ("policy_id", "ent_id", "insured_id", "insured_cert_no", "sku_charge_type", "sku_day_price")
    days = accrual_spans(policy, insured, product_codes, by_person=True, plan=plan).select(*keep, F.explode(S.days("first", "last")).alias("day"))
    return days.select(*keep, S.day_id("day").alias("day_id"))


def step_days(spans: DataFrame, key: str, amounts: dict[str, str]) -> DataFrame:
    """Per key and covered day, the sums of the amounts of the spans covering it.

    Change points are summed per (key, day) first, so the ordered pass sees at
    most one row per calendar day of a key however many spans it has.
    """
    def points(day, sign):
        return F.struct(day.alias("day"), F.lit(sign).alias("n"), *[(F.col(c) * sign).alias(a) for a, c in amounts.items()])

    moves = spans.select(key, F.explode(F.array(points(F.col("first"), 1), points(F.date_add("last", 1), -1))).alias("m")).select(
        key, "m.*"
    )
    per_day = moves.groupBy(key, "day").agg(F.sum("n").alias("n"), *[F.sum(a).alias(a) for a in amounts])
    w = Window.partitionBy(key).orderBy("day")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    steps = per_day.select(
        key,
        "day",
        F.sum("n").over(run).alias("n"),
        *[F.sum(a).over(run).alias(a) for a in amounts],
        F.date_sub(F.lead("day").over(w), 1).alias("until"),
    ).where((F.col("n") > 0) & F.col("until").isNotNull())
    return steps.select(key, F.explode(S.days("day", "until")).alias("day"), "n", *amounts)


def premium_policy_day(policy, insured, product_codes=None, plan=None) -> DataFrame:
    """Premium per policy and day."""
    spans = accrual_spans(policy, insured, product_codes, plan=plan).withColumn("amount", amount(F.col("persons")))
    return step_days(spans, "policy_id", {"charged_premium": "amount"}).select(
        "policy_id", S.day_id("day").alias("day_id"), F.col("charged_premium").cast("decimal(20,4)").alias("charged_premium")
    )


def premium_to_date(policy, insured, as_of: str, product_codes=None, plan=None) -> DataFrame:
    """Premium earned per policy up to and including a date."""
    spans = accrual_spans(policy, insured, product_codes, plan=plan)
    until = F.least(F.col("last"), F.lit(as_of).cast("date"))
    return (
        spans.where(F.col("first") <= F.lit(as_of).cast("date"))
        .groupBy("policy_id", "ent_id")
        .agg(F.sum(amount(F.col("persons"), S.day_count("first", until))).cast("decimal(24,4)").alias("charged_premium"))
    )


def premium_ent_month(policy, insured, product_codes=None, plan=None) -> DataFrame:
    """Premium per enterprise and calendar month; a span adds one row per month it touches."""
    spans = accrual_spans(policy, insured, product_codes, plan=plan).where(S.not_blank("ent_id"))
    parts = spans.select("ent_id", "first", "last", "persons", "sku_day_price", F.explode(S.months("first", "last")).alias("m"))
    n = S.day_count(F.greatest("first", "m"), F.least(F.col("last"), F.last_day("m")))
    return (
        parts.groupBy("ent_id", S.month_id("m").alias("month_id"))
        .agg(F.sum(amount(F.col("persons"), n)).cast("decimal(24,4)").alias("premium"))
    )


def premium_slope(months: DataFrame, as_of: str) -> DataFrame:
    """Growth of the monthly premium before the current month.

    ``slope``: mean monthly growth from the first to the last month;
    ``three_slope``: mean growth over the last two steps (0 below three months).
    """
    w = Window.partitionBy("ent_id").orderBy("month_id")
    p = F.col("premium").cast("double")
    rows = months.where(F.col("month_id") < as_of.replace("-", "")[:6]).select(
        "ent_id", "month_id", "premium", p.alias("p"), F.lag(p, 2).over(w).alias("third")
    )
    s = rows.groupBy("ent_id").agg(
        F.count("*").alias("n"),
        F.min("month_id").alias("first_month"),
        F.max("month_id").alias("last_month"),
        F.min_by("premium", "month_id").alias("first_d"),
        F.max_by("premium", "month_id").alias("last_d"),
        F.min_by("p", "month_id").alias("first"),
        F.max_by("p", "month_id").alias("last"),
        F.max_by(F.struct("third"), "month_id").getField("third").alias("third"),
        F.sum("premium").alias("total"),
    )
    growth = F.when((F.col("n") < 2) | (F.col("last") == F.col("first")), 0.0).otherwise(
        F.pow(F.col("last") / F.nullif("first", F.lit(0.0)), 1 / (F.col("n") - 1)) - 1
    )
    three = F.when(F.col("n") >= 3, F.sqrt(F.col("last") / F.nullif("third", F.lit(0.0))) - 1).otherwise(0.0)
    return s.select(
        "ent_id",
        "first_month",
        "last_month",
        F.round("first_d", 2).cast("double").alias("first_premium"),
        F.round("last_d", 2).cast("double").alias("last_premium"),
        F.bround(growth * 100, 2).alias("slope"),
        F.bround(three * 100, 2).alias("three_slope"),
        F.round("total", 2).cast("double").alias("premium_all"),
    )


def first_premium(policy, changes) -> DataFrame:
    """Premium at policy start: the total less all endorsement premium (added minus removed).

    ``changes``: policy_id, add_premium, del_premium.
    """
    net = changes.groupBy("policy_id").agg(
        (F.sum(F.coalesce("add_premium", F.lit(0))) - F.sum(F.coalesce("del_premium", F.lit(0)))).alias("net")
    )
    first = F.when(F.col("net").isNull(), F.col("premium")).otherwise(F.col("premium") - F.col("net"))
    return policy.join(net, "policy_id", "left").select("policy_id", first.cast("double").alias("first_premium"))


def job_type_premium(policy, insured, insured_term, plan, as_of: str) -> DataFrame:
    """Premium and persons per job type, over policies in effect by the date whatever their status.

    Every plan of a policy charges each of its persons: a yearly plan ('2') the person's own insured days,
    both ends counted, over 365 times the price, rounded half-even to cents; a monthly plan ('1') the price.
    Equal (policy, job type, days) are counted before they meet the plans, so a large policy arrives as few rows.
    """
    own = policy.where(S.day("effect_date") <= F.lit(as_of).cast("date")).where(S.not_blank("policy_code")).select("policy_id", "policy_code")
    terms = insured_term.select("policy_id", "insured_id", S.day_count(S.day("insured_start_date"), S.day("insured_end_date")).alias("days"))
    typed = insured.where(S.not_blank("insured_work_type")).select("policy_id", "insured_id", "insured_work_type")
    per = typed.join(terms, ["policy_id", "insured_id"], "left").groupBy("policy_id", "insured_work_type", "days").agg(F.count("*").alias("n"))
    plans = plan.where(F.col("sku_price").isNotNull() & F.col("sku_charge_type").isin("1", "2"))
    plans = plans.select("policy_code", "sku_charge_type", F.col("sku_price").cast("double").alias("price"))
    charged = per.join(own, "policy_id").join(plans, "policy_code").where((F.col("sku_charge_type") == "1") | F.col("days").isNotNull())
    yearly = F.bround(F.greatest(F.col("days"), F.lit(0)) / F.lit(365.0) * F.col("price"), 2)
    amount = F.when(F.col("sku_charge_type") == "2", yearly).otherwise(F.col("price")).cast("decimal(18,4)")
    return charged.groupBy("insured_work_type").agg(
        F.sum((amount * F.col("n")).cast("decimal(28,4)")).cast("double").alias("premium"), F.sum("n").alias("persons")
    )
