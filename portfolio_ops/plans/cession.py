"""Ceded-premium ratio per policy reference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portfolio_ops.functions.exprs import folded, guarded_ratio
from portfolio_ops.operators.filters import latest_period


def ceded_ratio(df: DataFrame, period: str, reference: str, premium: Column,
                ceded: list[str]) -> DataFrame:
    """One premium table: latest period, grouped sums, ratio of non-zero totals. Spellings of
    one reference are one group, named by the smallest."""
    zero = F.lit(0)
    amount = reduce(lambda a, b: a + b, [F.coalesce(name, zero) for name in ceded])
    totals = (latest_period(df, period).groupBy(folded(reference))
              .agg(F.min(reference).alias("AgressoReference"),
                   F.sum(premium).alias("_premium"), F.sum(amount).alias("_cession"))
              .filter((F.col("_premium") != 0) & (F.col("_cession") != 0)))
    return totals.select("AgressoReference",
                         guarded_ratio(F.col("_cession"), F.col("_premium")).alias("CessionMultiplier"))


def cession_multiplier(premium: DataFrame, marine: DataFrame, weather: DataFrame) -> DataFrame:
    """A reference present in two tables gives two rows. Only the first table books
    premium with the opposite sign."""
    parts = [
        ceded_ratio(premium, "Period2", "Reference", F.col("GPW") * -1,
                    ["ICWP_F", "ICWP_Q", "ICWP_S", "ICWP_EMBQ"]),
        ceded_ratio(marine, "Period2", "Reference", F.col("GrossWrittenPremium"),
                    ["CededPremiumToInternalQuotaShareTreaty", "CededPremiumToInternalFAC"]),
        ceded_ratio(weather, "Period2", "Reference", F.col("GrossWrittenPremium"),
                    ["CededPremiumToInternalQuotaShareTreaty", "CededPremiumToInternalSurplusTreaty"]),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
