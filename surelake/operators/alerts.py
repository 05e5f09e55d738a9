"""Early warnings on headcount changes, lost customers and deaths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import scalars as S

# Names and levels written into the warnings.
LEVEL = {1: "一级", 2: "二级", 3: "三级"}
NAMES = {"ADD": "大幅增员预警", "DEL": "大幅减员预警", "CUR_INSURED": "在保人数预警", "LOSS": "客户流失预警", "DEATH": "死亡案件预警"}


def alert_input(policy, ent_day, as_of: str) -> DataFrame:
    """Yesterday's and today's headcount and last month's peak per enterprise, from daily rows."""
    import datetime as dt

    today = dt.date.fromisoformat(as_of)
    yesterday = (today - dt.timedelta(days=1)).strftime("%Y%m%d")
    last_month = (today.replace(day=1) - dt.timedelta(days=1)).strftime("%Y%m")
    d, n = F.col("day_id"), F.col("curr_insured")
    per = ent_day.groupBy("ent_id").agg(
        F.sum(F.when(d == yesterday, n)).alias("y"),
        F.sum(F.when(d == today.strftime("%Y%m%d"), n)).alias("t"),
        F.max(F.when(d.startswith(last_month), n)).alias("m"),
    )
    names = policy.where(S.not_blank("ent_id")).select("ent_id", F.trim("holder_company").alias("ent_name")).distinct()
    return per.join(names, "ent_id").select(
        "ent_name",
        F.coalesce("y", F.lit(0)).alias("yesterday_insured_persons"),
        F.coalesce("t", F.lit(0)).alias("cur_insured_persons"),
        F.coalesce("m", F.lit(0)).alias("lastmonth_insured_persons_max"),
    )


def changes(ents: DataFrame, chan: DataFrame | None = None) -> DataFrame:
    """Headcount change per channel (or per enterprise without a channel map)."""
    rows = ents if chan is None else ents.join(chan.select("ent_name", "channel"), "ent_name")
    key = F.col("ent_name") if chan is None else F.col("channel")
    s = rows.groupBy(key.alias("name")).agg(
        F.sum("yesterday_insured_persons").alias("yesterday"),
        F.sum("cur_insured_persons").alias("today"),
        F.sum("lastmonth_insured_persons_max").alias("peak"),
    )
    diff = F.col("today") - F.col("yesterday")
    return s.select("name", "yesterday", "today", "peak", diff.alias("diff"), F.coalesce(S.ratio(diff, "yesterday"), F.lit(0.0)).alias("ratio"))


def _alert(rows: DataFrame, kind: str, as_of: str, value: Column, **fields: Column) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("type"),
        "name",
        F.lit(as_of.replace("-", "")).alias("day_id"),
        F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()], F.lit(NAMES[kind]).alias("name"))).alias("payload"),
        value.cast("double").alias("value"),
    )


def _level(*rules: tuple[Column, int], default: int) -> Column:
    out = None
    for cond, lv in rules:
        out = F.when(cond, LEVEL[lv]) if out is None else out.when(cond, LEVEL[lv])
    return out.otherwise(LEVEL[default])


def _common(ratio: Column) -> dict[str, Column]:
    return {
        "entName": F.col("name"),
        "yesterdayInsuredPersons": F.col("yesterday"),
        "curInsuredPersons": F.col("today"),
    }


def _fmt(c) -> Column:
    return F.format_string("%.4f", c)


def surge(ch: DataFrame, as_of: str, min_change: int = 200) -> DataFrame:
    rows = ch.where((F.col("diff") >= min_change) & (F.col("ratio") >= 0.1))
    return _alert(
        rows, "ADD", as_of, F.col("diff"), **_common(F.col("ratio")), addPersons=F.col("diff"), ringRatio=_fmt(F.col("ratio")),
        level=_level((F.col("ratio") >= 0.5, 2), default=1),
    )


def drop(ch: DataFrame, as_of: str, min_change: int = 200) -> DataFrame:
    rows = ch.where((F.col("diff") <= -min_change) & (F.col("ratio") <= -0.1))
    return _alert(
        rows, "DEL", as_of, F.col("diff"), **_common(F.col("ratio")), addPersons=F.col("diff"), ringRatio=_fmt(F.col("ratio")),
        level=_level((F.col("today") <= 10, 3), (F.col("ratio") <= -0.5, 2), default=1),
    )


def headcount_fall(ch: DataFrame, as_of: str) -> DataFrame:
    r = S.ratio("today", "peak")
    rows = ch.where((F.col("peak") != 0) & (r <= 0.7))
    return _alert(
        rows, "CUR_INSURED", as_of, F.col("today") - F.col("peak"), **_common(r), lmhInsuredPersonsMax=F.col("peak"), ringRatio=_fmt(r),
        level=_level((r <= 0.2, 3), (r <= 0.5, 2), default=1),
    )


def premium_history(policy, changes_, chan=None) -> DataFrame:
    """First and last endorsement day, net premium and added persons per channel."""
    per_policy = changes_.groupBy("policy_code").agg(
        F.sum(F.coalesce("add_premium", F.lit(0)) - F.coalesce("del_premium", F.lit(0))).alias("premium"),
        F.sum(F.coalesce("add_persons", F.lit(0))).alias("persons"),
        F.min("day_id").alias("first_day"),
        F.max("day_id").alias("last_day"),
    )
    rows = per_policy.join(policy.select("policy_code", F.trim("holder_company").alias("ent_name")), "policy_code")
    key = F.col("ent_name")
    if chan is not None:
        rows, key = rows.join(chan.select("ent_name", "channel"), "ent_name"), F.col("channel")
    return rows.groupBy(key.alias("name")).agg(
        F.sum("premium").cast("decimal(24,2)").alias("total_premium"),
        F.sum("persons").cast("bigint").alias("total_persons"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )


def lost(ch: DataFrame, history: DataFrame, as_of: str) -> DataFrame:
    """Nobody insured today, with the premium history of the customer."""
    rows = ch.where(F.col("today") == 0).join(history, "name")
    return _alert(
        rows, "LOSS", as_of, F.lit(0), **_common(F.col("ratio")), lmhInsuredPersonsMax=F.col("peak"), firstInsureTime=F.col("first_day"),
        lastOperTime=F.col("last_day"), totalPremium=F.col("total_premium"), totalPersons=F.col("total_persons"),
    )


def deaths(ents: DataFrame, policy, claims, money, chan, as_of: str, look_back: int = 1500) -> DataFrame:
    """Death claims in the look-back window with the loss ratio of the channel.

    ``money``: ent_name, charged_premium, payment. Each death case brings its
    enterprise's figures into the sums once, as the warning has always shown.
    """
    today = F.lit(as_of).cast("date")
    risk = S.slash_day("risk_date")
    per_policy = (
        claims.where((F.col("case_type") == codes.DEATH) & (risk > F.date_sub(today, look_back)) & (risk <= today))
        .groupBy("policy_no")
        .agg(F.count("*").alias("cases"))
    )
    pol = policy.select("policy_code", F.trim("holder_company").alias("ent_name"))
    per_ent = per_policy.join(pol, F.col("policy_no") == F.col("policy_code")).groupBy("ent_name").agg(F.sum("cases").alias("cases"))
    rows = per_ent.join(ents.select("ent_name", "cur_insured_persons"), "ent_name").join(money, "ent_name", "left")
    rows = rows.join(chan.select("ent_name", "channel"), "ent_name")
    s = rows.groupBy(F.col("channel").alias("name")).agg(
        F.sum(F.col("cur_insured_persons") * F.col("cases")).alias("persons"),
        F.sum(F.coalesce("charged_premium", F.lit(0)) * F.col("cases")).cast("decimal(24,4)").alias("premium"),
        F.sum(F.coalesce("payment", F.lit(0)) * F.col("cases")).cast("decimal(24,4)").alias("payment"),
        F.sum("cases").alias("cases"),
    )
    rate = F.when(F.col("payment") == 0, 0.0).when(F.col("premium") == 0, -1.0).otherwise(S.ratio("payment", "premium"))
    return _alert(
        s, "DEATH", as_of, F.col("cases"), entName=F.col("name"), curInsuredPersons=F.col("persons"),
        chargedPremium=F.col("premium").cast("decimal(24,2)"), payment=F.col("payment").cast("decimal(24,2)"), payrate=rate, countDeath=F.col("cases"),
    )


def all_alerts(*streams: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, streams)


def as_lines(alerts: DataFrame) -> DataFrame:
    """Export line ``uuid;TYPE;name;yyyyMMdd;;json;timestamp;value``."""
    return alerts.select(
        F.concat_ws(
            ";", F.regexp_replace(F.expr("uuid()"), "-", ""), "type", "name", "day_id", F.lit(""), "payload",
            F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"), F.col("value").cast("string"),
        ).alias("value")
    )
