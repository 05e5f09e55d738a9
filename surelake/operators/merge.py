"""One table out of two source systems: insured persons, endorsements, policies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

VOID_REMARK = "obsolete"


@dataclass(frozen=True)
class SourceRules:
    """Rows of the first system that are left out or let in by exception.

    ``test_users``: accounts whose policies are not real. ``prefix_product`` and
    ``code_prefix``: policies of this product whose code has this prefix come in
    whatever their user or remark.
    """

    test_users: tuple[str, ...] = ()
    prefix_product: str | None = None
    code_prefix: str | None = None

    def real_user(self, user: str = "user_id") -> Column:
        return S.excluded_or_null(user, *self.test_users) if self.test_users else F.lit(True)

    def by_prefix(self) -> Column:
        if self.prefix_product is None or self.code_prefix is None:
            return F.lit(False)
        return (F.col("insure_code") == self.prefix_product) & F.col("policy_code").startswith(self.code_prefix)

# Columns of the merged person table.
INSURED_COLUMNS = (
    "insured_id policy_id insured_type is_legal insured_name insured_gender insured_cert_type insured_cert_no insured_birthday "
    "insured_profession insured_mobile insured_industry insured_work_type insured_nation insured_company_name insured_company_phone "
    "is_chief_insurer insured_status insure_policy_status insured_create_time insured_update_time insured_start_date insured_end_date "
    "child_id child_name child_gender child_cert_type child_cert_no child_birthday child_nationality child_policy_status "
    "child_start_date child_end_date child_create_time age"
).split()


def pick(df: DataFrame, name: str) -> Column:
    """The column as text, or a missing value when the source has no such column."""
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def renamed(df: DataFrame, names: dict[str, str], **computed: Column) -> DataFrame:
    """Project to new names; ``names`` maps target to source."""
    return df.select(*[pick(df, src).alias(out) for out, src in names.items()], *[c.alias(k) for k, c in computed.items()])


def _conform(df: DataFrame, columns) -> DataFrame:
    return df.select(*[pick(df, c).alias(c) if c != "age" else F.col(c).cast("int") for c in columns])


_PERSON = {f"insured_{c}": c for c in "profession mobile industry nation company_name company_phone birthday start_date end_date create_time update_time".split()}
_CHILD = {f"child_{c}": c for c in "start_date end_date create_time".split()}


def insured_v1(person, child, policy, rules: SourceRules = SourceRules()) -> DataFrame:
    """First system: persons, children and policies, without void rows and test accounts,
    plus the prefix policies of the exception product (rows in both branches appear twice)."""
    p = renamed(
        person,
        {**_PERSON, "insured_id": "id", "policy_id": "policy_id", "insured_type": "insured_type", "is_legal": "is_legal",
         "insured_gender": "gender", "insured_cert_type": "cert_type", "is_chief_insurer": "is_chief_insurer",
         "insured_status": "status", "insure_policy_status": "insure_policy_status", "remark": "remark"},
        insured_name=S.keep_chinese(S.drop_newlines("name")),
        insured_work_type=S.keep_chinese(S.drop_newlines("work_type")),
        insured_cert_no=S.drop_newlines("cert_no"),
    )
    c = renamed(
        child,
        {**_CHILD, "child_id": "id", "for_insured": "insured_id", "child_name": "child_name", "child_gender": "child_gender",
         "child_cert_type": "child_cert_type", "child_cert_no": "child_cert_no", "child_birthday": "child_birthday",
         "child_nationality": "child_nationality", "child_policy_status": "child_policy_status"},
    )
    pol = renamed(policy, {"pol_id": "id", "user_id": "user_id", "insure_code": "insure_code", "policy_code": "policy_code"})
    rows = p.join(c, p.insured_id == c.for_insured, "left").join(pol, p.policy_id == pol.pol_id, "left")
    regular = rules.real_user() & S.excluded_or_null("remark", VOID_REMARK)
    by_prefix = rules.by_prefix()
    # one pass instead of a union of two filtered copies: a row is repeated for every branch it belongs to
    copies = F.coalesce(regular, F.lit(False)).cast("int") + F.coalesce(by_prefix, F.lit(False)).cast("int")
    rows = rows.withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return _conform(rows.withColumn("age", S.id_age("insured_cert_no", "insured_start_date")), INSURED_COLUMNS)


def insured_v2(master, slave, policy, as_of: str) -> DataFrame:
    """Second system: status and age are derived, children hang on the policy number."""
    now = F.lit(as_of).cast("date")
    live = (F.col("status") == "1") & (S.day("end_date") > now) & (S.day("start_date") < now)
    p = renamed(
        master,
        {**_PERSON, "insured_id": "id", "policy_no": "policy_no", "is_legal": "is_legal", "insured_gender": "sex",
         "insured_cert_type": "cert_type", "insured_profession": "profession_code", "insured_mobile": "tel", "insured_industry": "industry_code"},
        insured_type=F.lit(""),
        is_chief_insurer=F.lit("1"),
        insured_name=S.keep_chinese(S.drop_newlines("name")),
        insured_work_type=S.keep_chinese(S.drop_newlines("work_type")),
        insured_cert_no=S.drop_newlines("cert_no"),
        insured_status=F.when(F.col("status") == "1", "0").otherwise("1"),
        insure_policy_status=F.when(live, "1").otherwise("2"),
    )
    c = renamed(
        slave,
        {**_CHILD, "child_id": "id", "for_policy": "policy_no", "child_name": "name", "child_gender": "sex", "child_cert_type": "cert_type",
         "child_cert_no": "cert_no", "child_birthday": "birthday", "child_nationality": "nation"},
        child_policy_status=F.when(F.col("status") == "1", "0").otherwise("1"),
    )
    pol = renamed(policy, {"policy_id": "id", "pol_no": "policy_no"})
    rows = p.join(c, p.policy_no == c.for_policy, "left").join(pol, p.policy_no == pol.pol_no, "left")
    age = F.when((F.col("insured_cert_type") == "1") & F.col("insured_start_date").isNotNull(), S.id_age("insured_cert_no", "insured_start_date"))
    return _conform(rows.withColumn("age", age), INSURED_COLUMNS)


def merge_insured(v1: DataFrame, v2: DataFrame) -> DataFrame:
    return v1.unionByName(v2)


# ------------------------------------------------------------ endorsements


def endorse_dates(orders: DataFrame, persons: DataFrame) -> DataFrame:
    """Start and end of an endorsement from its persons.

    Start is the latest join date (leave date when there is none), end the
    earliest leave date (join date when there is none). An order that only
    removes persons has no start and ends a day later.
    """
    live = persons.where(S.excluded_or_null("remark", VOID_REMARK))
    j, l = F.col("join_date"), F.col("left_date")
    per = live.groupBy("preserve_id").agg(F.max(F.coalesce(j, l)).alias("s"), F.min(F.coalesce(l, j)).alias("e"))
    only_removes = (F.col("add_person_count") == 0) & (F.col("del_person_count") > 0)
    return orders.join(per, "preserve_id", "left").select(
        "preserve_id",
        F.when(~only_removes, S.day("s")).alias("pre_start_date"),
        F.when(only_removes, F.date_add(S.day("e"), 1)).otherwise(S.day("e")).alias("pre_end_date"),
    )


ENDORSE_COLUMNS = (
    "preserve_id policy_id policy_code preserve_status add_premium add_person_count del_premium del_person_count pre_start_date "
    "pre_end_date insured_name insured_cert_no insured_work_type insured_changetype join_date left_date"
).split()


def endorse_v1(orders, persons, policy_v2, order_dates: bool = False) -> DataFrame:
    """First system. ``order_dates`` takes the order's own dates instead of its persons' dates."""
    if order_dates:
        dated = orders.withColumns({"pre_start_date": S.day("start_date"), "pre_end_date": S.day("end_date")})
    else:
        dated = orders.join(endorse_dates(orders, persons), "preserve_id", "left")
    who = persons.where(S.excluded_or_null("remark", VOID_REMARK)).select(
        F.col("preserve_id").alias("for_order"),
        S.keep_chinese("name").alias("insured_name"),
        S.drop_newlines("cert_no").alias("insured_cert_no"),
        S.keep_chinese(S.drop_newlines("work_type")).alias("insured_work_type"),
        F.col("change_type").alias("insured_changetype"),
        "join_date",
        "left_date",
    )
    other = policy_v2.select(F.col("id").alias("other_id"), F.col("insurance_policy_no").alias("other_code"))
    rows = dated.join(who, dated.preserve_id == who.for_order, "left").join(other, F.col("policy_code") == F.col("other_code"), "left")
    rows = rows.withColumn("policy_id", F.coalesce(F.col("other_id").cast("string"), F.col("policy_id").cast("string")))
    return _conform(rows.where(F.col("insured_cert_no").isNotNull()), ENDORSE_COLUMNS)


def endorse_v2(orders, persons, policy_v2) -> DataFrame:
    """Second system: persons hang on (policy number, endorsement number); every order counts as done."""
    per = (
        persons.groupBy("policy_no", "revise_no")
        .agg(
            F.max(F.coalesce("start_date", "end_date")).alias("s"),
            F.min(F.coalesce("end_date", "start_date")).alias("e"),
        )
    )
    only_removes = (F.col("add_person_count") == 0) & (F.col("del_person_count") > 0)
    dated = orders.join(per, ["policy_no", "revise_no"], "left").withColumns(
        {
            "pre_start_date": F.when(~only_removes, S.day("s")),
            "pre_end_date": F.when(only_removes, F.date_add(S.day("e"), 1)).otherwise(S.day("e")),
            "preserve_status": F.lit("4"),
        }
    )
    who = persons.select(
        "policy_no",
        "revise_no",
        S.keep_chinese("name").alias("insured_name"),
        S.drop_newlines("cert_no").alias("insured_cert_no"),
        S.keep_chinese(S.drop_newlines("work_type")).alias("insured_work_type"),
        F.col("revise_status").alias("insured_changetype"),
        F.col("start_date").alias("join_date"),
        F.col("end_date").alias("left_date"),
    )
    pol = policy_v2.select(F.col("id").alias("policy_id"), "policy_no", F.col("insurance_policy_no").alias("policy_code"))
    rows = dated.join(pol, "policy_no", "left").join(who, ["policy_no", "revise_no"], "left")
    return _conform(rows.where(F.col("insured_cert_no").isNotNull()), ENDORSE_COLUMNS)


def merge_endorse(v1: DataFrame, v2: DataFrame) -> DataFrame:
    return v1.unionByName(v2)


# ---------------------------------------------------------------- policies

POLICY_COLUMNS = (
    "policy_id order_id user_id policy_code insure_code premium pay_amount policy_status start_date end_date order_date holder_name "
    "office_province product_name sku_coverage sku_append sku_ratio sku_charge_type ent_id ent_name number_of_people system_source"
).split()


def policy_v1(orders, policy, first_premium, product, sku, holder, enterprise_map, enterprise, rules: SourceRules = SourceRules()) -> DataFrame:
    """First system: orders lead, the rest hangs on by left joins.

    Pay amount prefers the recorded first premium, the order date falls back to
    the creation time, the province to the holder's. Test accounts are left out
    in either branch of the exception product.
    """
    from .base import plan_decode

    fp = first_premium.select(F.col("policy_id"), F.col("pay_amount").alias("first_pay"), F.lit(1).alias("has_first"))
    prod = product.select(F.col("product_code").alias("insure_code"), "product_name")
    terms = sku.select("sku_id", "sku_code", "term_one", "term_three")
    decoded = plan_decode(terms.withColumn("sku_code", F.col("sku_id"))).withColumnRenamed("sku_code", "sku_id").distinct()
    ents = enterprise_map.join(enterprise.select("ent_id", "ent_name", "office_province"), "ent_id", "left")
    rows = (
        orders.join(policy, "order_id", "left")
        .join(fp, "policy_id", "left")
        .join(prod, "insure_code", "left")
        .join(decoded, "sku_id", "left")
        .join(holder.select("policy_id", "holder_name", "holder_province"), "policy_id", "left")
        .join(ents, "policy_code", "left")
    )
    rows = rows.withColumns(
        {
            "pay_amount": F.when(F.col("has_first").isNotNull(), F.col("first_pay")).otherwise(F.col("pay_amount")),
            "order_date": F.coalesce("order_date", "order_create_time"),
            "office_province": F.coalesce("office_province", "holder_province"),
            "policy_status": F.col("status"),
            "number_of_people": F.col("quantity"),
            "system_source": F.lit("1.0"),
        }
    )
    known_product = F.col("insure_code").isNotNull()
    return _conform(rows.where(rules.real_user() & known_product), POLICY_COLUMNS)


def policy_v2(policy, plan, product, holder, enterprise_map, enterprise, as_of: str) -> DataFrame:
    """Second system: status from dates, the plan is one row per policy, injury share as a code."""
    now = F.lit(as_of).cast("date")
    # one plan per policy, picked in a fixed order
    first = F.struct("plan_amount", "contain_trainee", "injure_percent", "payment_type")
    plans = plan.groupBy("policy_no").agg(F.min(first).alias("p")).select(
        "policy_no",
        F.col("p.plan_amount").alias("sku_coverage"),
        F.col("p.contain_trainee").alias("sku_append"),
        F.when(F.col("p.injure_percent") == 0.05, "1").when(F.col("p.injure_percent") == 0.10, "2").alias("sku_ratio"),
        F.col("p.payment_type").alias("sku_charge_type"),
    )
    ents = enterprise_map.join(enterprise.select("ent_id", "ent_name", "office_province"), "ent_id", "left")
    rows = (
        policy.join(plans, "policy_no", "left")
        .join(product.select(F.col("product_code").alias("insure_code"), "product_name"), "insure_code", "left")
        .join(holder.select("policy_no", "holder_name"), "policy_no", "left")
        .join(ents, "policy_code", "left")
        .withColumns(
            {
                "policy_status": F.when((F.col("status") == "1") & (S.day("end_date") >= now), "1").otherwise("0"),
                "system_source": F.lit("2.0"),
            }
        )
    )
    return _conform(rows, POLICY_COLUMNS)


def merge_policy(v1: DataFrame, v2: DataFrame) -> DataFrame:
    return v1.unionByName(v2)
