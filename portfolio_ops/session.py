"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split skewed join partitions even where a later step wanted their partitioning
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # hash join instead of sort-merge when every measured build partition is small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # no Python call-site capture per expression: wide plans build about twice as fast
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "portfolio_ops", master: str | None = None,
                  **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    A folder of our own is made only on a local master, where the driver's disk
    is the executors' disk; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="portfolio_ops_")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


# what is kept on disk: text keys are hex digits, which entropy coding halves
CODEC = "zstd"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """A statement run inside deletes its shuffle files when it ends. Else they stay until the
    driver's garbage is collected, beside those of all later statements of a job."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def write_rows(df: DataFrame, path: str) -> None:
    """Write a table that is read again, and keep nothing else of it on disk."""
    with shuffles_released(df.sparkSession):
        df.write.option("compression", CODEC).parquet(path)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result is read more than once and must be the same each time
    (partition numbers of a range partitioning), or where several statements
    read one intermediate table. The files survive the loss of executors.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "staged", f"{label}-{uuid.uuid4().hex}")
    write_rows(df, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems, so that any store works."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def unstage(df: DataFrame) -> None:
    """Delete the files of a table made by ``stage``, once nothing reads it any more."""
    path = df.__dict__.pop("_staged_at", None)
    if path:
        remove(df.sparkSession, path)
