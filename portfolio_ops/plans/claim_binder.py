"""Distinct (policy number, binder reference) pairs of claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.functions.exprs import flag_off, folded, same_text
from portfolio_ops.operators.dedupe import distinct_text
from portfolio_ops.operators.lookups import merge_join


def claim_binder_pairs(exposures: DataFrame, claims: DataFrame,
                       source: str = fv.CLAIM_BINDER_SOURCE) -> DataFrame:
    left = (exposures.filter(same_text("SourceSystem", source) & F.col("BinderReference").isNotNull())
            .select(folded("SourceSystem").alias("_s"), folded("ClaimSourceId").alias("_c"),
                    "BinderReference"))
    right = (claims.filter(same_text("SourceSystem", source) & flag_off("IsRetired"))
             .select(folded("SourceSystem").alias("_s"), folded("ClaimSourceId").alias("_c"),
                     "PolicyNumber"))
    pairs = merge_join(left, right, ["_c", "_s"]).select("PolicyNumber", "BinderReference")
    return distinct_text(pairs, ["PolicyNumber", "BinderReference"], folded)
