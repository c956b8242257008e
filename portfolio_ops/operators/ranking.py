"""Dense rank over a whole table without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portfolio_ops.session import stage

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within partition below


def key_ranks(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Distinct keys with their dense rank, missing keys last.

    Distinct keys (map-side combined) are range partitioned and sorted, and the
    result is written once so that partition numbers cannot change between the
    two reads below. The rank is the row's place in its partition plus the number
    of keys in earlier partitions; the running total has one row per partition.
    """
    order = [F.col(k).asc_nulls_last() for k in keys]
    ordered = (df.select(*keys).distinct()
               .repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_id", F.monotonically_increasing_id()))
    placed = (stage(ordered, "ranks")
              .withColumn("_part", F.shiftright("_id", _ROW_BITS))
              .withColumn("_row", F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1))
              .drop("_id"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_keys"))
               .select("_part", F.coalesce(F.sum("_keys").over(before), F.lit(0)).alias("_before")))
    # one row per shuffle partition, so its size is bounded by the session's partition number
    return (placed.join(F.broadcast(offsets), "_part")
            .select(*keys, (F.col("_before") + F.col("_row") + 1).cast("long").alias(out)))


def global_dense_rank(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """``DENSE_RANK() OVER (ORDER BY keys)`` for every row of ``df``."""
    ranks = key_ranks(df, keys, out)
    renamed = ranks.select(*[F.col(k).alias(f"_r_{k}") for k in keys], out)
    cond = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = same if cond is None else cond & same
    return df.join(renamed, cond, "left").select(*df.columns, out)
