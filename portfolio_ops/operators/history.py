"""Satellite history that accepts rows in any order, and a table of it in two parts.

``load_satellite`` compares a batch with the current version of each key. Here all that is
known of the keys of a batch is put in order again, so late rows become versions at their
place. A loaded row that told nothing new is kept beside the versions: a late row before it
may make it a version.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portfolio_ops.functions.hashing import hash_key
from portfolio_ops.operators.dedupe import first_per_key
from portfolio_ops.operators.ordered import GROUP_ROWS, Ordered, windowing
from portfolio_ops.operators.vault import open_end
from portfolio_ops.session import exists, stage


@dataclass(frozen=True)
class Columns:
    """Names of a satellite's columns."""

    key: str
    attributes: Sequence[str]
    load: str = "LOAD_DATETIME"
    hash: str = "HASH_DIFF"
    end: str = "END_DATETIME"
    current: str = "IS_CURRENT_FLAG"

    def loaded(self, names: Sequence[str]) -> list[str]:
        """The columns that a loaded row has before it is a version."""
        return [n for n in names if n not in (self.end, self.current)]

    def by_time(self) -> list[Column]:
        return [F.col(self.load).asc(), F.col(self.hash).asc_nulls_last()]


@dataclass(frozen=True)
class History:
    versions: DataFrame     # the satellite
    confirmed: DataFrame    # loaded rows that equal the version before them


def without_time(src: DataFrame, names: Columns) -> DataFrame:
    """Batch rows that no history can take: those without a load time."""
    return src.filter(F.col(names.load).isNull())


def restitch(stored: History, src: DataFrame, names: Columns, group_rows: int = GROUP_ROWS) -> History:
    """The history after a batch, whatever the order of batches: as if all rows had come sorted.

    For the keys of the batch, versions, confirmed rows and batch are put in order of time (ties by
    hash), copies of one (key, time, hash) reduced to one, and a row is a version when its hash differs from
    the one before it; start, end and current flag follow. Rows of other keys stay as they are.
    Rows without a time are left out (``without_time``). A replayed batch changes nothing.
    """
    columns = stored.versions.columns
    loaded = names.loaded(columns)
    batch = src.withColumn(names.hash, hash_key(src, names.attributes)) \
        .filter(F.col(names.load).isNotNull()).select(*loaded)
    touched = batch.select(F.col(names.key).alias("_key")).distinct()
    same = F.col(names.key).eqNullSafe(F.col("_key"))

    def known(df: DataFrame) -> DataFrame:
        return df.select(*loaded).join(touched, same, "left_semi")
    rows = known(stored.versions).unionByName(known(stored.confirmed)).unionByName(batch)
    rest = [n for n in loaded if n not in (names.key, names.load, names.hash)]
    rows = first_per_key(rows, [names.key, names.load, names.hash], [F.col(n).asc_nulls_last() for n in rest])

    window = windowing(src, [names.key], group_rows)
    seen = window(rows, Ordered([names.key], names.by_time(), position="_place", lags={"_before": names.hash}))
    told = (F.col("_place") == 1) | ~F.col(names.hash).eqNullSafe(F.col("_before"))
    ordered = stage(seen.select(*loaded, told.alias("_version")), "restitched")

    ended = window(ordered.filter("_version"), Ordered([names.key], names.by_time(), leads={"_next": names.load}))
    versions = ended.withColumns({names.end: F.coalesce("_next", open_end()),
                                  names.current: F.col("_next").isNull()}).select(*columns)
    return History(
        stored.versions.join(touched, same, "left_anti").unionByName(versions),
        stored.confirmed.join(touched, same, "left_anti").unionByName(
            ordered.filter(~F.col("_version")).select(*loaded)))


BUCKET, PART = "key_bucket", "is_current"


class TwoPartSatellite:
    """A satellite as Parquet in partitions of (current or closed, bucket of the key).

    A batch reads the current versions and confirmed rows of the buckets that its keys fall in. Versions that it
    closes are added to the closed part, the current part of those buckets is overwritten
    (Spark's dynamic partition overwrite); files of other buckets are not touched. Only buckets
    with a late row, one not later than the start of its key's current version, have their closed part read and written
    anew. At most ``buckets`` numbers reach the driver.

    Not atomic over its folders: after a failure between the writes the same batch is
    loaded again, which gives the same rows. One load at a time.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, names: Columns, buckets: int = 64):
        self._spark, self.base, self.names, self.buckets = spark, base, names, buckets
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        self._loaded = T.StructType([f for f in self.schema if f.name in names.loaded(self.schema.names)])

    def _read(self, folder: str, schema: T.StructType, *parts: str) -> DataFrame:
        whole = T.StructType([*schema.fields, *(T.StructField(
            n, T.BooleanType() if n == PART else T.IntegerType()) for n in parts)])
        path = f"{self.base}/{folder}"
        if not exists(self._spark, path):
            return self._spark.createDataFrame([], whole)
        return self._spark.read.schema(whole).parquet(path)

    def _versions(self) -> DataFrame:
        return self._read("versions", self.schema, PART, BUCKET)

    def read(self) -> DataFrame:
        """All versions."""
        return self._versions().select(*self.schema.names)

    def read_current(self) -> DataFrame:
        """Current versions; only their files are read."""
        return self._versions().filter(F.col(PART)).select(*self.schema.names)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.names.key), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, folder: str, parts: list[str], mode: str) -> None:
        df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts) \
            .parquet(f"{self.base}/{folder}")

    def load(self, src: DataFrame, group_rows: int = GROUP_ROWS) -> None:
        n = self.names
        src = stage(src.filter(F.col(n.load).isNotNull()), "batch")  # read by several statements
        in_bucket = src.withColumn(BUCKET, self._bucket())
        starts = self._versions().filter(F.col(PART)).select(
            F.col(n.key).alias("_key"), F.col(n.load).alias("_start"), F.col(BUCKET).alias("_bucket"))
        late = F.coalesce(F.col(n.load) <= F.col("_start"), F.lit(False))
        found = in_bucket.join(starts, (F.col(BUCKET) == F.col("_bucket")) & F.col(n.key).eqNullSafe(F.col("_key")),
                               "left").groupBy(BUCKET).agg(F.max(late).alias("late")).collect()
        ordinary = [r[BUCKET] for r in found if not r["late"]]
        again = [r[BUCKET] for r in found if r["late"]]
        confirmed = self._read("confirmed", self._loaded, BUCKET)
        for chosen, whole in ((ordinary, False), (again, True)):
            if not chosen:
                continue
            stored = self._versions().filter(F.col(BUCKET).isin(chosen))
            if not whole:
                stored = stored.filter(F.col(PART))
            made = restitch(
                History(stored.select(*self.schema.names),
                        confirmed.filter(F.col(BUCKET).isin(chosen)).select(*self._loaded.names)),
                in_bucket.filter(F.col(BUCKET).isin(chosen)).drop(BUCKET), n, group_rows)
            versions = stage(made.versions.withColumns({PART: F.col(n.current), BUCKET: self._bucket()}), "parts")
            kept = stage(made.confirmed.withColumn(BUCKET, self._bucket()), "confirmed")
            if not whole:
                self._add_closed(versions.filter(~F.col(PART)), chosen)
                versions = versions.filter(F.col(PART))
            self._write(versions.repartition(PART, BUCKET), "versions", [PART, BUCKET], "overwrite")
            self._write(kept.repartition(BUCKET), "confirmed", [BUCKET], "overwrite")

    def _add_closed(self, closed: DataFrame, chosen: Sequence[int]) -> None:
        """Closed versions that the closed part has not yet (it has them when a load is repeated)."""
        n = self.names
        told = self._versions().filter(~F.col(PART) & F.col(BUCKET).isin(list(chosen))).select(
            F.col(n.key).alias("_key"), F.col(n.load).alias("_load"), F.col(n.hash).alias("_hash"))
        same = (F.col(n.key).eqNullSafe(F.col("_key")) & (F.col(n.load) == F.col("_load"))
                & F.col(n.hash).eqNullSafe(F.col("_hash")))
        fresh = stage(closed.join(told, same, "left_anti"), "closed")
        self._write(fresh.repartition(PART, BUCKET), "versions", [PART, BUCKET], "append")
