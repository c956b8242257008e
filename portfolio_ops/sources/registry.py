"""Names of tables and views, including three-part and oddly spelled names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSource:
    path: str | None = None          # Parquet folder or file
    table: str | None = None         # catalogue name, already quoted
    schema: T.StructType | None = None


def quoted(name: str) -> str:
    """``[db].[schema].[TBL:Odd Name]`` or ``db.schema.table`` as a backtick-quoted name."""
    parts, part, bracket = [], "", False
    for char in name:
        if char == "[" and not bracket:
            bracket = True
        elif char == "]" and bracket:
            bracket = False
        elif char == "." and not bracket:
            parts.append(part)
            part = ""
        else:
            part += char
    parts.append(part)
    return ".".join(f"`{p.replace('`', '``')}`" for p in parts)


class Registry:
    """Maps source-system names to Spark tables or Parquet paths, case-insensitively."""

    def __init__(self, spark: SparkSession, sources: Mapping[str, TableSource | str]):
        self._spark = spark
        self._sources = {
            quoted(name).lower(): TableSource(path=src) if isinstance(src, str) else src
            for name, src in sources.items()}

    def read_table(self, name: str) -> DataFrame:
        source = self._sources.get(quoted(name).lower())
        if source is None:
            return self._spark.table(quoted(name))
        if source.table:
            return self._spark.table(source.table)
        reader = self._spark.read
        if source.schema is not None:
            reader = reader.schema(source.schema)
        return reader.parquet(source.path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
