"""Data changes: each returns the new table, publishing it is a separate step."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portfolio_ops.functions.exprs import c, is_true, like_any
from portfolio_ops.session import shuffles_released, stage


def _complete(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def spread_incomplete(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Extra join key that is 0 for complete keys and a row hash for the others.

    Keys with a missing part never match, so the hash changes no result; it keeps rows
    with missing keys from meeting in one task.
    """
    return df.withColumn(out, F.when(_complete(keys), F.lit(0).cast("long"))
                         .otherwise(F.xxhash64(*df.columns)))


def reject_repeated_keys(df: DataFrame, keys: Sequence[str], what: str = "source",
                         partition_by: Sequence[str] = ()) -> DataFrame:
    """Fail when a complete key occurs twice, without a separate pass.

    The row number uses the hash partitioning and sort the following join on the
    same keys needs anyway. Keys with a missing part never match and may repeat.
    """
    columns = [*keys, *partition_by]
    number = F.row_number().over(Window.partitionBy(*columns).orderBy(*columns))
    bad = (F.col("_copy") > 1) & _complete(keys)
    message = F.concat(F.lit(f"repeated {what} key: "),
                       F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    return (df.withColumn("_copy", number)
            .filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
            .drop("_copy"))


def merge_snapshot(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str,
                   update_cols: Sequence[str], delete_missing: bool = True) -> DataFrame:
    """Hash-gated merge as one full outer join on the keys.

    * matched, hashes differ: ``update_cols`` (and the hash) from the source, every
      other column keeps its stored value (insert-only columns);
    * matched, hashes equal or either missing: stored row untouched;
    * source only: inserted whole;
    * target only: dropped when ``delete_missing``, else kept.
    """
    stored = spread_incomplete(target, keys, "_spread")
    stored = stored.select(*[F.col(n).alias(f"_t_{n}") for n in stored.columns],
                           F.lit(True).alias("_in_t"))
    fresh = reject_repeated_keys(spread_incomplete(source, keys, "_spread"), keys,
                                 partition_by=["_spread"]).withColumn("_in_s", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_t_{k}") for k in [*keys, "_spread"]])
    joined = stored.join(fresh, on, "full")

    has_t, has_s = is_true(F.col("_in_t")), is_true(F.col("_in_s"))
    changed = has_t & has_s & is_true(F.col(hash_col) != F.col(f"_t_{hash_col}"))
    taken = set(update_cols) | {hash_col}
    missing = [n for n in target.columns if n not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")

    def value(name: str) -> Column:
        from_source = ~has_t | changed if name in taken else ~has_t
        kind = target.schema[name].dataType
        return (F.when(from_source, F.col(name).cast(kind))
                .otherwise(F.col(f"_t_{name}")).alias(name))

    if delete_missing:
        joined = joined.filter(has_s)
    return joined.select(*[value(n) for n in target.columns])


NEW, CHANGED, GONE = "new", "changed", "gone"
# touched keys are few up to one in so many stored rows
FEW_TOUCHED = 10


def merge_decisions(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str) -> DataFrame:
    """(keys, stored hash ``_old``, ``_verdict``) for the complete keys that a merge touches.

    A full outer join of keys and hashes alone; keys whose hashes agree, or of which either is
    missing, are not listed. Copies of a stored key are judged each by its own hash.
    """
    stored = target.filter(_complete(keys)).select(
        *[F.col(k).alias(f"_t_{k}") for k in keys], F.col(hash_col).alias("_old"), F.lit(True).alias("_in_t"))
    fresh = reject_repeated_keys(source.filter(_complete(keys)).select(*keys, F.col(hash_col).alias("_new")),
                                 keys).withColumn("_in_s", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_t_{k}") for k in keys])
    verdict = (F.when(F.col("_in_t").isNull(), NEW).when(F.col("_in_s").isNull(), GONE)
               .when(is_true(F.col("_old") != F.col("_new")), CHANGED))
    return (stored.join(fresh, on, "full").withColumn("_verdict", verdict).filter("_verdict is not null")
            .select(*[F.coalesce(k, f"_t_{k}").alias(k) for k in keys], "_old", "_verdict"))


def merge_by_hash(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str,
                  update_cols: Sequence[str], delete_missing: bool = True) -> DataFrame:
    """The rows of ``merge_snapshot``, for tables of which a load changes little.

    Keys and hashes are joined first and the touched keys staged; wide rows are then looked up
    by these. While the touched keys are few, Spark broadcasts them by their measured size and
    no wide row is shuffled. When they are counted as more than one of ``FEW_TOUCHED`` stored rows,
    ``merge_snapshot`` moves less, as it moves each side once, and makes the result. Both sides are
    read more than once, so pass stored or staged tables.
    """
    missing = [n for n in target.columns if n not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    touched = stage(merge_decisions(target, source, keys, hash_col), "decisions")
    with shuffles_released(target.sparkSession):
        many = touched.count() * FEW_TOUCHED > target.count()
    if many:
        return merge_snapshot(target, source, keys, hash_col, update_cols, delete_missing)

    def having(*verdicts: str, old: bool = False) -> DataFrame:
        names = [F.col(k).alias(f"_d_{k}") for k in keys]
        return touched.filter(F.col("_verdict").isin(*verdicts)).select(
            *names, *([F.col("_old").alias("_d_old")] if old else []))
    by_key = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_d_{k}") for k in keys])
    by_row = by_key & F.col(hash_col).eqNullSafe(F.col("_d_old"))
    as_stored = [F.col(n).cast(target.schema[n].dataType).alias(n) for n in target.columns]

    dropped = having(CHANGED, GONE, old=True) if delete_missing else having(CHANGED, old=True)
    kept = target.join(dropped, by_row, "left_anti")
    if delete_missing:
        kept = kept.filter(_complete(keys))     # a missing key part never matches a source row
    added = source.filter(_complete(keys)).join(having(NEW), by_key, "left_semi") \
        .unionByName(source.filter(~_complete(keys))).select(*as_stored)

    taken = set(update_cols) | {hash_col}
    old_rows = target.join(having(CHANGED, old=True), by_row, "left_semi")
    new_rows = source.join(having(CHANGED), by_key, "left_semi").select(
        *[F.col(k).alias(f"_s_{k}") for k in keys],
        *[F.col(n).cast(target.schema[n].dataType).alias(f"_n_{n}") for n in target.columns if n in taken])
    both = old_rows.join(new_rows, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys]))
    changed = both.select(*[F.col(f"_n_{n}").alias(n) if n in taken else F.col(n) for n in target.columns])
    return kept.unionByName(added).unionByName(changed)


def not_stored(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose keys are not in the target.

    A missing key part never matches, so such rows count as new. The stored side is
    reduced to its distinct keys before the join.
    """
    stored = target.select(*[F.col(k).alias(f"_s_{k}") for k in keys]).distinct()
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    return source.join(stored, on, "left_anti")


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str],
               dedupe_within_batch: Sequence[Column] | None = None) -> DataFrame:
    """Rows to append. Copies inside the batch stay unless an order is given to pick one."""
    rows = not_stored(source, target, keys)
    if dedupe_within_batch:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*dedupe_within_batch))
        rows = rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
    return rows


def drop_superseded(df: DataFrame, against: DataFrame, reference: str, source: str,
                    pairs: Sequence[tuple[str, str]],
                    fold: Callable[[str], Column] = F.col) -> DataFrame:
    """Remove (reference, old source) rows where ``against`` has the newer source.

    ``pairs`` lists (old source, newer source). The other side is reduced to one row
    per reference and old source, so a frequent reference costs one row.
    """
    def text(value: str) -> Column:
        return fold(F.lit(value)) if fold is not F.col else F.lit(value)

    newer = None
    for old, new in pairs:
        part = (against.filter(fold(source) == text(new))
                .select(fold(reference).alias("_ref"), text(old).alias("_old")))
        newer = part if newer is None else newer.unionByName(part)
    newer = newer.distinct()
    return df.join(newer, (fold(reference) == F.col("_ref")) & (fold(source) == F.col("_old")),
                   "left_anti")


# -- fills ------------------------------------------------------------------

def fill_from_group_max(df: DataFrame, group: Column | str, column: str) -> DataFrame:
    """Fill a missing value with the largest one of the group.

    Grouped aggregate plus join rather than a window: the maximum is combined before
    the shuffle and the rows of one group are never gathered in one task.
    """
    best = (df.filter(F.col(column).isNotNull() & c(group).isNotNull())
            .groupBy(c(group).alias("_group")).agg(F.max(column).alias("_best")))
    return (df.join(best, c(group) == F.col("_group"), "left")
            .withColumn(column, F.coalesce(column, "_best")).drop("_group", "_best"))


def fill_from_first(df: DataFrame, group: Column | str, first: Column, when_missing: str,
                    columns: Sequence[str]) -> DataFrame:
    """Take ``columns`` from the group's first row where ``when_missing`` is NULL.

    All columns are replaced together, also by NULL, as one update would. Several
    first rows in a group are resolved to the largest combination.
    """
    side = (df.filter(first & c(group).isNotNull())
            .groupBy(c(group).alias("_group"))
            .agg(F.max(F.struct(when_missing, *[n for n in columns if n != when_missing]))
                 .alias("_from")))
    take = F.col(when_missing).isNull() & F.col("_group").isNotNull()
    joined = df.join(side, c(group) == F.col("_group"), "left")
    # decide once, before the tested column itself is replaced
    joined = joined.withColumn("_take", take)
    return joined.withColumns(
        {n: F.when(F.col("_take"), F.col(f"_from.{n}")).otherwise(F.col(n)) for n in columns}
    ).drop("_group", "_from", "_take")


# -- assignment from a mapping ----------------------------------------------

def mapping_by_class(mapping: DataFrame, key: str, value: str,
                     classes: dict[str, Sequence[str]], ignore_case: bool = False) -> DataFrame:
    """One row per key with one column per class: the largest value LIKE its patterns."""
    return mapping.groupBy(F.col(key).alias("_map_key")).agg(*[
        F.max(F.when(like_any(value, patterns, ignore_case), F.col(value))).alias(name)
        for name, patterns in classes.items()])


def assign_by_class(df: DataFrame, mapping: DataFrame, key: Column,
                    out: str, rule: Column) -> DataFrame:
    """Left join the pivoted mapping and set ``out`` by ``rule`` over its class columns."""
    joined = df.join(mapping, key == F.col("_map_key"), "left")
    extra = [n for n in mapping.columns]
    return joined.withColumn(out, rule).drop(*extra)


def total_per_group(df: DataFrame, keys: Sequence[str], amount: Column | str, out: str) -> DataFrame:
    """Attach the sum over the group to every row (grouped aggregate joined back)."""
    total = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(F.sum(c(amount)).alias(out))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_g_{k}") for k in keys])
    return df.join(total, on).drop(*[f"_g_{k}" for k in keys])
