"""Ledger reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Match states and the placeholder of an unmatched key.
MATCHED, UNMATCHED, NONE = "匹配成功", "匹配失败", "无"


def recon_match(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Every row of the large ledger with the summed figures of the small one and a match state.

    The small ledger is summed per key first, so a key can never fan out.
    """
    sums = small.groupBy(*keys).agg(
        F.sum("premium").alias("small_premium"), F.sum("settlement").alias("small_settlement"), F.lit(True).alias("hit")
    )
    hit = F.col("hit").isNotNull()
    return big.join(sums, keys, "left").select(
        *[F.when(hit, F.col(k)).otherwise(NONE).alias(k) if k in keys else F.col(k) for k in big.columns],
        "small_premium",
        "small_settlement",
        F.when(hit, MATCHED).otherwise(UNMATCHED).alias("machine"),
    )


def recon_unmatched(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of one ledger that the other one lacks."""
    return a.join(b.select(*keys).distinct(), keys, "left_anti")
