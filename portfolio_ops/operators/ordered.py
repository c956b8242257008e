"""Positions, running sums, neighbours and group sizes inside ordered groups.

Two ways to the same result:

* plain - one window specification, one shuffle on the keys, one sort;
* segmented - for groups too large for one task. Rows are range partitioned on
  (keys, order), so a group is cut into consecutive segments; windows run inside
  segments, and one summary row per segment carries position, sums and
  neighbouring values across the cuts.

``ordered_groups`` sends each group to the way that fits its size. Nothing is
dropped, capped or sampled on either way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portfolio_ops.session import shuffles_released, stage

# a group above this many rows is cut into segments
GROUP_ROWS = 4_000_000
# rows that make a segment worth a task of its own, while there are no more than this many segments
SEGMENT_ROWS = 10_000
MANY_SEGMENTS = 200
# rows up to which the segments of a larger table grow before their number does
FULL_SEGMENT_ROWS = 1_000_000
# hash buckets of keys by which groups are looked for
KEY_BUCKETS = 4096


@dataclass(frozen=True)
class Ordered:
    """What to compute per ordered group; names are output columns."""

    keys: Sequence[str]
    order: Sequence[Column]
    position: str | None = None
    group_size: str | None = None
    running: Mapping[str, str] = field(default_factory=dict)      # out <- column
    lags: Mapping[str, str] = field(default_factory=dict)         # out <- column
    leads: Mapping[str, str] = field(default_factory=dict)        # out <- column
    missing: Mapping[str, object] = field(default_factory=dict)   # out -> value with no neighbour


def _or_missing(spec: Ordered, out: str, kind) -> Column:
    return F.lit(spec.missing.get(out)).cast(kind)


def plain(df: DataFrame, spec: Ordered) -> DataFrame:
    whole = Window.partitionBy(*spec.keys)
    seq = whole.orderBy(*spec.order)
    upto = seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new: dict[str, Column] = {}
    if spec.position:
        new[spec.position] = F.row_number().over(seq).cast("long")
    for out, name in spec.running.items():
        new[out] = F.sum(name).over(upto)
    for out, name in spec.lags.items():
        new[out] = F.lag(name, 1, spec.missing.get(out)).over(seq)
    for out, name in spec.leads.items():
        new[out] = F.lead(name, 1, spec.missing.get(out)).over(seq)
    if spec.group_size:
        new[spec.group_size] = F.count(F.lit(1)).over(whole)
    return df.withColumns(new)


def segmented(df: DataFrame, spec: Ordered, segments: int | None = None) -> DataFrame:
    """``segments`` sets the number of range partitions; left out, the session does."""
    parts = [segments] if segments else []
    cut = (df.repartitionByRange(*parts, *[F.col(k) for k in spec.keys], *spec.order)
           .withColumn("_seg", F.spark_partition_id()))
    cut = stage(cut, "segments")  # segment numbers must be the same in every read

    whole = Window.partitionBy(*spec.keys, "_seg")
    seq = whole.orderBy(*spec.order)
    upto = seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside: dict[str, Column] = {"_pos": F.row_number().over(seq).cast("long"),
                                 "_seg_rows": F.count(F.lit(1)).over(whole)}
    for out, name in spec.running.items():
        inside[f"_in_{out}"] = F.sum(name).over(upto)
    for out, name in spec.lags.items():
        inside[f"_in_{out}"] = F.lag(name).over(seq)
    for out, name in spec.leads.items():
        inside[f"_in_{out}"] = F.lead(name).over(seq)

    # a bound between two segments cuts at most one group, so these and their segments are few,
    # whatever the number of groups and rows
    cut_groups = (cut.groupBy(*[F.col(k).alias(f"_k_{k}") for k in spec.keys])
                  .agg(F.min("_seg").alias("_first"), F.max("_seg").alias("_last")).filter("_first < _last"))
    in_cut = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in spec.keys])
    parts = cut.join(F.broadcast(cut_groups), in_cut, "left_semi")
    summary = parts.withColumns(inside).groupBy(*spec.keys, "_seg").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(name).alias(f"_sum_{out}") for out, name in spec.running.items()],
        *[F.max_by(name, "_pos").alias(f"_last_{out}") for out, name in spec.lags.items()],
        *[F.min_by(name, "_pos").alias(f"_first_{out}") for out, name in spec.leads.items()],
    )
    group = Window.partitionBy(*spec.keys)
    by_seg = group.orderBy("_seg")
    earlier = by_seg.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *[F.col(k).alias(f"_c_{k}") for k in spec.keys], F.col("_seg").alias("_c_seg"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_cut_before"),
        F.sum("_rows").over(group).alias("_cut_size"),
        *[F.sum(f"_sum_{out}").over(earlier).alias(f"_carry_{out}") for out in spec.running],
        *[F.lag(f"_last_{out}").over(by_seg).alias(f"_carry_{out}") for out in spec.lags],
        *[F.lead(f"_first_{out}").over(by_seg).alias(f"_carry_{out}") for out in spec.leads],
    )
    same = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in spec.keys],
                  F.col("_seg") == F.col("_c_seg"))
    # no row of a group that is not cut has a match: it starts and ends in its segment
    rows = cut.withColumns(inside).join(F.broadcast(carry), same, "left").withColumns({
        "_before": F.coalesce("_cut_before", F.lit(0)), "_size": F.coalesce("_cut_size", "_seg_rows")})

    types = {f.name: f.dataType for f in rows.schema.fields}
    new: dict[str, Column] = {}
    place = F.col("_before") + F.col("_pos")
    if spec.position:
        new[spec.position] = place
    for out in spec.running:
        own, kept = F.col(f"_in_{out}"), F.col(f"_carry_{out}")
        new[out] = (F.when(kept.isNull(), own).when(own.isNull(), kept)
                    .otherwise(kept + own).cast(types[f"_in_{out}"]))
    for out in spec.lags:
        new[out] = (F.when(F.col("_pos") > 1, F.col(f"_in_{out}"))
                    .when(F.col("_before") > 0, F.col(f"_carry_{out}"))
                    .otherwise(_or_missing(spec, out, types[f"_in_{out}"])))
    for out in spec.leads:
        new[out] = (F.when(F.col("_pos") < F.col("_seg_rows"), F.col(f"_in_{out}"))
                    .when(place < F.col("_size"), F.col(f"_carry_{out}"))
                    .otherwise(_or_missing(spec, out, types[f"_in_{out}"])))
    if spec.group_size:
        new[spec.group_size] = F.col("_size")
    return rows.withColumns(new).select(*df.columns, *_outputs(spec))


def _outputs(spec: Ordered) -> list[str]:
    names = [spec.position] if spec.position else []
    names += [*spec.running, *spec.lags, *spec.leads]
    return names + ([spec.group_size] if spec.group_size else [])


@dataclass(frozen=True)
class LargeGroups:
    """Keys of groups too large for one task, and the segments that all of them fill."""

    keys: DataFrame
    segments: int

    def segmented(self, df: DataFrame, spec: Ordered) -> DataFrame:
        return segmented(df, spec, self.segments)


def segment_count(rows: int, group_rows: int, segment_rows: int = SEGMENT_ROWS) -> int:
    """Range partitions for the rows of all large groups together.

    Range partitioning cuts at quantiles of (keys, order) over all of them, so several groups
    share a partition and a group is cut only where it is larger. Twice what the rows fill,
    as the quantiles are sampled; never segments under half of ``segment_rows`` on average.

    Each segment costs a block of every task before it and a sample on the driver, so above
    ``MANY_SEGMENTS`` segments grow, up to ``FULL_SEGMENT_ROWS`` or ``group_rows``, before there are more.
    """
    def filled(size: int) -> int:
        return max(1, -(-2 * rows // max(group_rows, size)))
    return min(filled(segment_rows), max(MANY_SEGMENTS, filled(FULL_SEGMENT_ROWS)))


def large_groups(df: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS,
                 segment_rows: int = SEGMENT_ROWS) -> LargeGroups | None:
    """Groups above ``group_rows``, or None when there are none.

    A table of no more rows has none: Parquet answers that count from its footers. Else rows
    are counted by a few hash buckets, unless these are large themselves: a large group lies in a large
    bucket, so only rows of such buckets are counted by their keys. That count is combined before its
    shuffle; its keys are staged only when there are large groups, of which at most ``rows / group_rows`` exist.
    """
    with shuffles_released(df.sparkSession):
        total = df.count()
        if total <= group_rows:
            return None
        if 4 * total <= group_rows * KEY_BUCKETS:
            bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
            sizes = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
            suspect = [r["_bucket"] for r in sizes.filter(F.col("_n") > group_rows).collect()]
            if not suspect:
                return None
            df = df.filter(bucket.isin(suspect))
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > group_rows)
        rows = counted.agg(F.sum("_n")).first()[0]
        if rows is None:
            return None
        return LargeGroups(stage(counted.drop("_n"), "large"), segment_count(rows, group_rows, segment_rows))


def split_by(df: DataFrame, large: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of other groups, rows of large groups); missing keys compare equal."""
    side = large.select(*[F.col(k).alias(f"_l_{k}") for k in keys])
    same = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_l_{k}")) for k in keys])
    return df.join(side, same, "left_anti"), df.join(side, same, "left_semi")


def windowing(sized_by: DataFrame, keys: Sequence[str],
              group_rows: int = GROUP_ROWS) -> Callable[[DataFrame, Ordered], DataFrame]:
    """How to run specs over groups of these keys: large groups segmented, the rest plain.

    Group sizes are counted on ``sized_by``, which may be a cheaper table than the one
    windowed (for example the base table before joins). They only decide the way
    taken, never the result.
    """
    large = large_groups(sized_by, keys, group_rows)
    if large is None:
        return plain

    def by_size(df: DataFrame, spec: Ordered) -> DataFrame:
        small_rows, large_rows = split_by(df, large.keys, keys)
        return plain(small_rows, spec).unionByName(large.segmented(large_rows, spec))
    return by_size


def ordered_groups(df: DataFrame, spec: Ordered, group_rows: int = GROUP_ROWS,
                   sized_by: DataFrame | None = None) -> DataFrame:
    """``spec`` for every group, each on the way that fits its size."""
    return windowing(sized_by if sized_by is not None else df, spec.keys, group_rows)(df, spec)


def reverse_position(position: Column | str, group_size: Column | str) -> Column:
    pos = F.col(position) if isinstance(position, str) else position
    size = F.col(group_size) if isinstance(group_size, str) else group_size
    return size + 1 - pos


def balance_columns(measures: Mapping[str, tuple[str, Column]]) -> tuple[dict[str, Column], dict[str, str]]:
    """Inputs for running balances of ``LAG(carried, 1, 0) + flow``.

    The sum over a prefix of the lagged value is the prefix sum of ``carried``
    without its current row, so the balance needs running sums only:
    ``sum(carried + flow) - carried``. ``carried`` must not be NULL.
    Returns the columns to add and the running sums to request.
    """
    add = {f"_flow_{out}": F.col(carried) + flow for out, (carried, flow) in measures.items()}
    return add, {f"_run_{out}": f"_flow_{out}" for out in measures}
