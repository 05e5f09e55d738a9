"""Web-analytics ETL and the CRM mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S


def shift_times(df: DataFrame, hours: int = 8, drop_containing: str = "custom_var") -> DataFrame:
    """Move every time in a table forward, whatever column holds it.

    Timestamps move by type. Text moves when it looks like a date with time or
    like a time of day; other text is unchanged.
    """
    out = []
    for f in df.schema.fields:
        if drop_containing in f.name:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = S.plus_hours(f.name, hours)
        elif isinstance(f.dataType, T.StringType):
            dated = c.contains(":") & c.contains("-") & S.is_signed_digits(F.substring_index(c, "-", 1))
            clock = (
                c.contains(":") & ~c.contains("-")
                & S.is_signed_digits(F.split_part(c, F.lit(":"), F.lit(1)))
                & S.is_signed_digits(F.split_part(c, F.lit(":"), F.lit(2)))
            )
            moved = F.when(dated, S.plus_hours_text(c, hours)).when(clock, S.plus_hours_time_of_day(c, hours))
            c = F.coalesce(moved, c)
        elif isinstance(f.dataType, T.BinaryType):
            c = F.hex(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def with_names(df: DataFrame, names: DataFrame, key: str, lookups: dict[str, str], default: str = "0") -> DataFrame:
    """Translate several code columns through one code table (``key, name``); unknown codes give the default."""
    out = df
    for code, target in lookups.items():
        dim = names.select(F.col(key).alias(code), F.col("name").alias(target))
        out = out.join(dim, code, "left").withColumn(target, F.coalesce(target, F.lit(default)))
    return out


def web_actions(links: DataFrame, visits: DataFrame, actions: DataFrame) -> DataFrame:
    """Link actions with readable action names and the visit they belong to."""
    named = with_names(links, actions, "idaction", {"idaction_url": "idaction_url_name", "idaction_name": "idaction_name_vt"})
    v = visits.select("idvisit", "visit_first_action_time", "visit_last_action_time", "visit_total_actions")
    return named.join(v, "idvisit")


def crm_mart(customers: DataFrame, options: DataFrame, business: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Customers with coded fields spelled out, joined to their businesses.

    ``options``: field, key, value. ``fields`` maps a customer column to its field.
    """
    out = customers
    for column, field in fields.items():
        dim = options.where(F.col("field") == field).select(F.col("key").alias(column), F.col("value").alias(f"{column}_label"))
        out = out.join(dim, column, "left")
    return out.join(business, "customer_id", "left").distinct()


def latest_channel(mart: DataFrame) -> DataFrame:
    """Channel of the most recently updated customer per enterprise; the customer name stands in for a missing one."""
    name = F.trim(F.coalesce("ent_name", "name"))
    return mart.where(name.isNotNull()).groupBy(name.alias("name")).agg(
        F.max_by(F.struct("channel_label", "level"), F.struct("update_time", "channel_label", "level")).alias("top"),
        F.max("update_time").alias("update_time"),
    ).select("name", F.col("top.channel_label").alias("channel_label"), F.col("top.level").alias("level"), "update_time")
