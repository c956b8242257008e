"""Row hashes and hash keys over text made from typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portfolio_ops.functions import fixed_values as fv


def _as_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.date_format(col, fv.HASH_TIME_FORMAT)
    if isinstance(kind, T.TimestampNTZType):  # no zone of its own: written as UTC
        local = fv.HASH_TIME_FORMAT.removesuffix("xxx")
        return F.concat(F.date_format(col, local), F.lit("+00:00"))
    if isinstance(kind, T.BinaryType):
        return F.hex(col)
    return col.cast("string")


def joined_text(df: DataFrame, columns: Sequence[str]) -> Column:
    parts: list[Column] = []
    for name in columns:
        if parts:
            parts.append(F.lit(fv.HASH_SEPARATOR))
        parts.append(F.coalesce(_as_text(df, name), F.lit(fv.HASH_NULL)))
    return F.concat(*parts)


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """32-byte SHA-256 of the '#'-joined fields, missing fields as ``NULL``."""
    return F.unhex(F.sha2(joined_text(df, columns), 256))


def hash_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """32 hex characters identifying a business key; parts cannot run together."""
    parts: list[Column] = []
    for name in columns:
        text = _as_text(df, name)
        # length prefix keeps ('a','bc') apart from ('ab','c'), and NULL from 'NULL'
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text),
                                F.lit("-")))
        parts.append(F.lit("|"))
    return F.md5(F.concat(*parts[:-1]))
