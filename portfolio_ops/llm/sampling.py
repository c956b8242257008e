"""Bounded samples to fit models on. Only fitting reads a sample; applying reads every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; a null id has remainder -1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(-1))


def passage(text: Column, doc_id: Column, size: int) -> Column:
    """``size`` characters of a text from a place chosen by its id, all of a shorter text."""
    room = F.greatest(F.length(text) - size, F.lit(0)) + 1
    start = F.pmod(F.xxhash64(doc_id, F.lit("passage")), room.cast("long")).cast("int") + 1
    return F.substring(text, start, F.lit(size))


def bounded_sample(rows: DataFrame, size: int) -> DataFrame:
    """About ``size`` rows chosen by the hash of ``doc_id``, never more than twice as many."""
    total = rows.count()
    if total <= size:
        return rows
    share = int(size / total * (1 << 30))
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share) \
        .limit(2 * size)
