"""Projections applied where rows land: JSON paths, topic metadata, defaults, lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_paths(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    """Add text columns taken from a JSON column; keys are case-sensitive.

    A string column is parsed once per row into a variant shared by all paths. A
    missing path, a JSON null and unreadable text give NULL.
    """
    kind = df.schema[column].dataType
    doc = F.col(column) if isinstance(kind, T.VariantType) else F.try_parse_json(F.col(column))
    parsed = df.withColumn("_doc", doc)
    return parsed.withColumns(
        {out: F.try_variant_get("_doc", path, "string") for out, path in paths.items()}
    ).drop("_doc")


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Column defaults at insert: absent columns are added, missing values filled."""
    new: dict[str, Column] = {}
    for name, value in defaults.items():
        value = value if isinstance(value, Column) else F.lit(value)
        new[name] = F.coalesce(name, value) if name in df.columns else value
    return df.withColumns(new)


def with_lineage(df: DataFrame, process_id: Column | object, source: str | None = None,
                 created_from: str | None = None) -> DataFrame:
    """Audit columns of an insert."""
    pid = process_id if isinstance(process_id, Column) else F.lit(process_id)
    new = {"created_at_ts": F.current_timestamp(), "created_by": F.current_user(), "process_id": pid}
    if source is not None:
        new["source_name"] = F.lit(source)
    if created_from is not None:
        new["created_from"] = F.lit(created_from)
    return df.withColumns(new)


def with_surrogate(df: DataFrame, column: str) -> DataFrame:
    """Generated id: unique, not dense, no shuffle."""
    return df.withColumn(column, F.monotonically_increasing_id())


TOPIC_COLUMNS = {"timestamp": "RECORD_KAFKA_NPTS", "offset": "RECORD_KAFKA_OFFSET",
                 "partition": "RECORD_KAFKA_PARTITION"}


def land_events(records: DataFrame, content: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """Topic records with their metadata columns, for batch and streaming input alike."""
    named = [F.col(src).alias(out) for src, out in TOPIC_COLUMNS.items() if src in records.columns]
    return records.select(*keep, F.col(content).cast("string").alias("RECORD_CONTENT"), *named)
