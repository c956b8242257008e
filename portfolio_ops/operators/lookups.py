"""Joins to lookup tables. None is hinted: adaptive execution broadcasts a side whose measured
bytes are under the session's threshold and splits skewed partitions otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup(df: DataFrame, table: DataFrame, key: Column, table_key: Column,
           values: dict[str, Column]) -> DataFrame:
    """Left join on a computed key; ``values`` maps output names to table columns."""
    side = table.select(table_key.alias("_lk"), *[v.alias(n) for n, v in values.items()])
    return (df.withColumn("_key", key)
            .join(side, F.col("_key") == F.col("_lk"), "left")
            .drop("_key", "_lk"))


def map_codes(df: DataFrame, column: str, table: DataFrame, code: str, text: str,
              out: str | None = None) -> DataFrame:
    """Code list held in a table, unknown codes pass through."""
    found = lookup(df, table, F.col(column), F.col(code), {"_text": F.col(text)})
    return found.withColumn(out or column, F.coalesce("_text", F.col(column).cast("string"))).drop("_text")


def merge_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join forced to sort-merge."""
    return left.join(right.hint("merge"), list(keys), how)


def with_one_row(df: DataFrame, one: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach the values of a one-row table (a run id) as scalar subqueries.

    A scalar subquery fails by itself when the table has more than one row, and an
    empty table gives NULL, which is refused here.
    """
    for name in columns:
        value = one.select(name).scalar()
        df = df.withColumn(name, F.coalesce(
            value, F.raise_error(F.lit(f"no row to take {name} from"))))
    return df
