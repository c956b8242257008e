"""Queries over the driver tables and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portfolio_ops.sources.registry import read_table
from portfolio_ops.sources.snapshot import nullable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.folder = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its oracle SQL."""
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def money(name: str | Column) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    return col.cast("decimal(19,4)")


def double(name: str | Column, alias: str | None = None) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    return col.cast("double").alias(alias or name)


def day(name: str | Column, alias: str | None = None) -> Column:
    col = F.col(name) if isinstance(name, str) else name
    return F.date_format(col, "yyyy-MM-dd").alias(alias or name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order; absent ones are NULL."""
    return df.to(nullable(schema))


def flat(df: DataFrame) -> DataFrame:
    """Comparable types: decimals to double, times to text, flags to 0/1, integers to long."""
    out = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.DecimalType):
            name = f"CAST({name} AS DOUBLE) AS {name}"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            name = f"date_format({name}, 'yyyy-MM-dd') AS {name}"
        elif isinstance(f.dataType, (T.BooleanType, T.IntegerType)):
            name = f"CAST({name} AS BIGINT) AS {name}"
        elif isinstance(f.dataType, T.BinaryType):
            name = f"lower(hex({name})) AS {name}"
        out.append(name)
    return df.selectExpr(*out)
