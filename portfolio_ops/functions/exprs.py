"""Column expressions shared by the jobs. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from portfolio_ops.functions import fixed_values as fv

MONEY = "decimal(19,4)"
RATE = "decimal(19,12)"


def c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- comparison rules -------------------------------------------------------

def folded(col: Column | str) -> Column:
    """Comparison key of a case-insensitive, blank-padded host string.

    Joins and groupings on this key are plain binary string operations, so they
    keep hash joins, hash aggregation and codegen.
    """
    return F.lower(F.rtrim(c(col)))


def same_text(col: Column | str, value: str) -> Column:
    return folded(col) == F.lit(value.rstrip().lower())


def text_in(col: Column | str, values: Iterable[str]) -> Column:
    return folded(col).isin([v.rstrip().lower() for v in values])


def is_true(pred: Column) -> Column:
    """Three-valued predicate to two values: unknown counts as false."""
    return F.coalesce(pred, F.lit(False))


def is_empty(col: Column | str) -> Column:
    """Missing or '' exactly; a blank is a value."""
    return F.coalesce(c(col), F.lit("")) == ""


def is_blank(col: Column | str) -> Column:
    return F.coalesce(F.rtrim(c(col)), F.lit("")) == ""


def like_any(col: Column | str, patterns: Iterable[str],
             ignore_case: bool = False) -> Column:
    """LIKE any of the patterns; ``_`` stays a one-character wildcard."""
    text = F.lower(c(col)) if ignore_case else c(col)
    tests = [text.like(p.lower() if ignore_case else p) for p in patterns]
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def flag_off(col: Column | str) -> Column:
    """True when an optional 0/1 flag is 0 or missing."""
    return F.coalesce(c(col).cast("int"), F.lit(0)) == 0


def flag_on(col: Column | str) -> Column:
    return is_true(c(col).cast("int") == 1)


# -- code maps --------------------------------------------------------------

def map_literal(col: Column | str, mapping: Mapping[str, str],
                default: Column | None = None, ignore_case: bool = False) -> Column:
    """Fixed code list as a CASE chain; unknown codes give ``default`` or NULL."""
    key = folded(col) if ignore_case else c(col)
    chain = None
    for code, text in mapping.items():
        test = key == F.lit(code.lower() if ignore_case else code)
        chain = F.when(test, F.lit(text)) if chain is None else chain.when(test, F.lit(text))
    if chain is None:
        return default if default is not None else F.lit(None).cast("string")
    return chain.otherwise(default) if default is not None else chain


def map_section_status(col: Column | str) -> Column:
    return map_literal(col, fv.SECTION_STATUS, ignore_case=True)


def map_state(col: Column | str) -> Column:
    return map_literal(col, fv.STATE_NAMES, default=c(col), ignore_case=True)


def source_priority(col: Column | str) -> Column:
    return (F.when(text_in(col, fv.PRIORITY_ONE_SOURCES), 1)
            .when(same_text(col, fv.PRIORITY_TWO_SOURCE), 2)
            .otherwise(3))


# -- numbers ----------------------------------------------------------------

def numeric_or_zero(col: Column | str) -> Column:
    """Text amount, or 0 when it is not a number."""
    return F.coalesce(c(col).try_cast(MONEY), F.lit(0).cast(MONEY))


def guarded_ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def zero_to_one(col: Column | str) -> Column:
    return F.when(c(col) == 0, F.lit(1)).otherwise(c(col))


def negate_where(columns: Iterable[str], cond: Column) -> dict[str, Column]:
    """Replacement columns for ``withColumns``: flip the sign where ``cond`` holds."""
    test = is_true(cond)
    return {name: F.when(test, -F.col(name)).otherwise(F.col(name)) for name in columns}


# -- currency ---------------------------------------------------------------

def reporting_currency(col: Column | str) -> Column:
    return (F.when(c(col).isin(fv.KEPT_CURRENCIES), c(col))
            .otherwise(F.lit(fv.REPORTING_CURRENCY)))


# 1 / NUMBER keeps six decimals on the old host; amounts depend on it
RATIO = "decimal(19,6)"


def settlement_to_usd(currency: Column | str, group_rate: Column | str,
                      ratio: Column | str) -> Column:
    return (F.when(c(currency).isin(fv.KEPT_CURRENCIES), F.lit(1).cast(RATIO))
            .when(F.coalesce(c(group_rate), F.lit(0)) == 0, F.lit(1).cast(RATIO))
            .otherwise(c(ratio).cast(RATIO)))


# -- text and dates ---------------------------------------------------------

def section_suffix(reference: Column | str, sequence: Column | str) -> Column:
    """``REF-07``. NULL reference gives NULL; more than two digits is an error."""
    number = c(sequence).cast("int")
    text = F.right(F.concat(F.lit("0"), number.cast("string")), F.lit(2))
    checked = F.when(number.between(0, 99), text).when(
        number.isNotNull(),
        F.raise_error(F.concat(F.lit("section sequence does not fit two digits: "),
                               number.cast("string"))).cast("string"))
    return F.concat(c(reference), F.lit("-"), checked)


def first_of_month(col: Column | str) -> Column:
    return F.date_trunc("MONTH", c(col).cast("timestamp_ntz")).cast("timestamp_ntz")


def left_part(col: Column | str, length: int) -> Column:
    return F.substring(c(col), 1, length)


def required(col: Column | str, name: str) -> Column:
    """The column, or an error naming it when the value is NULL."""
    return F.coalesce(c(col), F.raise_error(F.lit(f"NULL in required column {name}")))
