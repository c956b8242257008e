"""Row filters and the scalar aggregates that feed them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.functions.exprs import c, flag_off, flag_on, is_true


def only_active(df: DataFrame, active: Sequence[str] = (), off: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose ``active`` flags are 1 and whose ``off`` flags are 0 or missing."""
    for name in active:
        df = df.filter(flag_on(name))
    for name in off:
        df = df.filter(flag_off(name))
    return df


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """SQL DELETE: rows for which the predicate is unknown stay."""
    return df.filter(~is_true(pred))


def required_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def touched_at(created: Column | str, modified: Column | str) -> Column:
    return F.coalesce(c(modified), c(created))


def changed_since(mark: Column | dt.datetime, *times: Column) -> Column:
    """True when any of the times is at or after the mark (inclusive)."""
    # stored times carry no zone, so the mark must not pass through the session's zone
    bound = (mark if isinstance(mark, Column)
             else F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz"))
    tests = [is_true(t >= bound) for t in times]
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def touched_since(mark: dt.datetime, created: str, modified: str) -> Column:
    """``touched_at(created, modified)`` at or after the mark, in a form that Parquet scans take."""
    bound = F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
    return (F.col(modified) >= bound) | (F.col(modified).isNull() & (F.col(created) >= bound))


def stored_state(stored: DataFrame, created: str, modified: str) -> tuple[dt.datetime, bool]:
    """High-water mark and whether this is a first load, in one aggregate.

    The mark prefers the modify time; the first-load test looks at the create
    time only. One row of two values reaches the driver.
    """
    row = stored.agg(
        F.max(touched_at(created, modified)).cast("timestamp_ntz").alias("mark"),
        F.max(created).isNull().alias("first_load"),
    ).first()
    mark = row["mark"] or dt.datetime.fromisoformat(fv.FIRST_LOAD_MARK)
    return mark, row["first_load"]


def high_water_mark(stored: DataFrame, created: str, modified: str) -> dt.datetime:
    return stored_state(stored, created, modified)[0]


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of the largest period, by an uncorrelated scalar subquery.

    The subquery runs once and its value is pushed to the Parquet scan.
    """
    newest = df.agg(F.max(period)).scalar()
    return df.filter(F.col(period) == newest)
