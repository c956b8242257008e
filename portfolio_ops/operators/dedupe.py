"""One row per key.

Top-1 filters are written as ``row_number() = 1``: Spark plans a group limit
before the shuffle, so a key holding a large share of the rows leaves each map
task as a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portfolio_ops.session import stage


def first_per_key(df: DataFrame, keys: Sequence[Column | str],
                  order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[Column | str], newest: Sequence[str]) -> DataFrame:
    """Newest row per key; a missing time sorts first when descending."""
    return first_per_key(df, keys, [F.col(name).desc_nulls_first() for name in newest])


def newest_keys(df: DataFrame, reference: str, key: str,
                reference_key: Column | None = None, own_key: Column | None = None) -> DataFrame:
    """(``_ref``, ``_newest``) of the references with several keys."""
    value = own_key if own_key is not None else F.col(key)
    ref = reference_key if reference_key is not None else F.col(reference)
    return (df.filter(F.col(key).isNotNull())
            .groupBy(ref.alias("_ref")).agg(F.max(value).alias("_newest"), F.min(value).alias("_oldest"))
            .filter(F.col("_ref").isNotNull() & (F.col("_oldest") < F.col("_newest"))).drop("_oldest"))


def keep_max_key(df: DataFrame, reference: str, key: str, reference_key: Column | None = None,
                 own_key: Column | None = None, newest: DataFrame | None = None) -> DataFrame:
    """Drop rows whose key is below the largest key of their reference.

    Rows without a reference or without a key are not comparable and stay. The
    maximum is a grouped aggregate joined back, so the rows of one reference are
    never gathered in one task. Only references with several keys are joined: where they are few, no row
    is shuffled. ``reference_key`` and ``own_key`` give what is compared
    where that is not the column itself, such as its folded text. ``newest`` are the ``newest_keys`` of the
    same arguments, where they are staged already.
    """
    value = own_key if own_key is not None else F.col(key)
    ref = reference_key if reference_key is not None else F.col(reference)
    if newest is None:
        newest = newest_keys(df, reference, key, reference_key, own_key)
    joined = df.withColumn("_own", ref).join(newest, F.col("_own") == F.col("_ref"), "left")
    keep = (F.col("_ref").isNull() | F.col(key).isNull()
            | (value == F.col("_newest")))
    return joined.filter(keep).drop("_own", "_ref", "_newest")


def distinct_text(df: DataFrame, columns: Sequence[str], fold) -> DataFrame:
    """DISTINCT that compares text columns by ``fold``; the smallest spelling is kept."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    keyed = df.groupBy(*[(fold(name) if name in text else F.col(name)).alias(f"_k_{name}")
                         for name in columns])
    return keyed.agg(*[F.min(name).alias(name) for name in columns]).select(*columns)


def distinct_rows(df: DataFrame, columns: Sequence[str], fold) -> DataFrame:
    """``distinct_text`` for wide rows of which few are repeated.

    Rows are counted by a 64-bit digest of what is compared, so eight bytes a row are shuffled.
    Rows whose digest occurs once are distinct as they are; only the others are compared by
    their columns, so rows that merely share a digest stay apart. The rows are staged, as
    they are read again once the digests are known.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    digest = F.xxhash64(*[fold(n) if n in text else F.col(n) for n in columns])
    rows = stage(df.select(*columns, digest.alias("_digest")), "distinct")
    repeated = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_digest")
    once = rows.join(repeated, "_digest", "left_anti").select(*columns)
    again = rows.join(repeated, "_digest", "left_semi").select(*columns)
    return once.unionByName(distinct_text(again, columns, fold))
