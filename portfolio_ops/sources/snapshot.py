"""Append, full refresh and all-or-nothing publishing over Parquet folders.

A table is a folder with data folders and a log. A publish writes its rows to a new data
folder, checks them, and only then appends a log row that names the folders it adds (append)
or starts anew with (replace, compact). Readers take the rows from the newest start on. A
failure at any point before the log row leaves the previous version in place, and no path is
ever overwritten while it is read. One writer per table is assumed, as for the scheduled jobs
that load it.

Tables that are published together share a log: the rows of all of them are one committed
file, so either every table switches or none does. After ``COMPACT_FOLDERS`` appends a publish
rewrites the version as one folder, which bounds the log rows and folders that a reader takes.
``vacuum`` deletes folders that no kept version names.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from portfolio_ops.operators.contract import Contract, ContractViolation, enforce
from portfolio_ops.session import remove, shuffles_released, write_rows

COMPACT_FOLDERS = 64

LOG_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("folders", T.ArrayType(T.StringType())),
    T.StructField("rows_written", T.LongType()),
    T.StructField("mode", T.StringType()),
    T.StructField("batch", T.StringType()),
])
STARTS = ("replace", "compact")


@dataclass(frozen=True)
class LoadResult:
    table: str
    version: int
    rows_inserted: int


class SnapshotTable:
    """``log`` is the folder of a log shared with other tables; left out, the table has its own."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, log: str | None = None):
        self._spark = spark
        self.base = base.rstrip("/")
        self.log = (log or f"{self.base}/log").rstrip("/")
        self.schema = schema

    def history(self) -> DataFrame | None:
        """Log rows of this table, or None before the first publish."""
        try:
            log = self._spark.read.schema(LOG_SCHEMA).json(self.log)
        except AnalysisException as error:  # no version published yet
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return log.filter(F.col("table") == self.base)

    def _current(self, kept: int = 1) -> list:
        """Log rows from the ``kept``-newest start on, oldest first; few, as publishes compact."""
        log = self.history()
        if log is None:
            return []
        starts = [r["version"] for r in log.filter(F.col("mode").isin(*STARTS)).select("version")
                  .orderBy(F.col("version").desc()).take(kept)]
        first = starts[-1] if len(starts) == kept else 0
        with shuffles_released(self._spark):
            return log.filter(F.col("version") >= first).orderBy("version").collect()

    def _folders(self) -> tuple[int, list[str]]:
        rows = self._current()
        return (rows[-1]["version"] if rows else 0), [f for r in rows for f in r["folders"]]

    def version(self) -> int:
        return self._folders()[0]

    def has_batch(self, batch: str) -> bool:
        log = self.history()
        return log is not None and not log.filter(F.col("batch") == batch).isEmpty()

    def read(self) -> DataFrame:
        return self.folder(*self._folders()[1])

    def folder(self, *names: str) -> DataFrame:
        if not names:
            return self._spark.createDataFrame([], self.schema)
        return self._spark.read.schema(self.schema).parquet(*[f"{self.base}/{n}" for n in names])

    def publish(self, df: DataFrame, mode: str = "replace", contract: Contract | None = None,
                parents: Mapping[str, DataFrame] | None = None,
                batch: str | None = None, check: str = "added") -> LoadResult:
        """Write, check and switch. ``mode`` is ``replace`` or ``append``.

        An append adds a folder and rewrites nothing. Its contract is checked on the written
        rows and their keys against the stored ones; ``check="whole"`` checks the whole new
        version instead.
        """
        return publish_together([Load(self, df, contract, parents, mode, batch, check)])[0]

    def compact(self) -> LoadResult:
        """Rewrite the current version as one folder, after many appends."""
        folder, rows = self.write(self.read())
        return switch([(self, [folder], rows, "compact", None)])[0]

    def write(self, df: DataFrame) -> tuple[str, int]:
        """Write rows to a new data folder nobody reads yet; (folder, row count)."""
        folder = f"data/{uuid.uuid4().hex}"
        counted = Observation()
        write_rows(select_for(df, self.schema).observe(counted, F.count(F.lit(1)).alias("rows")),
                   f"{self.base}/{folder}")
        return folder, counted.get["rows"]

    def check(self, load: Load, folder: str) -> None:
        """The load's contract on its written rows."""
        contract, added = load.contract, self.folder(folder)
        if contract is None:
            return
        if load.mode != "append" or load.check == "whole":
            stored = self._folders()[1] if load.mode == "append" else []
            enforce(self.folder(*stored, folder), contract, load.parents)
            return
        enforce(added, contract, load.parents)
        for rule, columns in contract.unique.items():
            # few keys against many: a missing key part never matches
            again = added.join(self.read().select(*columns), list(columns), "left_semi").count()
            if again:
                raise ContractViolation(f"{rule}: {again}")

    def vacuum(self, kept_versions: int = 1) -> int:
        """Delete data folders that the versions since the ``kept_versions``-newest start do not
        name: superseded versions and failed publishes. Not while a publish runs."""
        named = {f.rpartition("/")[2] for r in self._current(kept_versions) for f in r["folders"]}
        path = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/data")
        files = path.getFileSystem(self._spark._jsc.hadoopConfiguration())
        found = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        gone = [n for n in found if n not in named]
        for name in gone:
            remove(self._spark, f"{self.base}/data/{name}")
        return len(gone)


@dataclass(frozen=True)
class Load:
    """Rows for a table. A parent given as a table of the same publish stands for the rows written to it."""

    table: SnapshotTable
    rows: DataFrame
    contract: Contract | None = None
    parents: Mapping[str, DataFrame | SnapshotTable] | None = None
    mode: str = "replace"
    batch: str | None = None
    check: str = "added"


def publish_together(loads: Sequence[Load]) -> list[LoadResult]:
    """Publish several tables of one job: all are written and checked before any is switched,
    and tables with one log are switched by one committed file."""
    prepared = [(load, *load.table.write(load.rows)) for load in loads]
    written = {load.table: load.table.folder(folder) for load, folder, _ in prepared}
    for load, folder, _ in prepared:
        parents = {n: (written[p] if p in written else p.read()) if isinstance(p, SnapshotTable) else p
                   for n, p in (load.parents or {}).items()}
        load.table.check(replace(load, parents=parents), folder)
    results = switch([(load.table, [folder], rows, load.mode, load.batch)
                      for load, folder, rows in prepared])
    for load in loads:
        if load.mode == "append" and len(load.table._folders()[1]) > COMPACT_FOLDERS:
            load.table.compact()
    return results


def switch(entries: Sequence[tuple]) -> list[LoadResult]:
    """Log rows of (table, folders, rows written, mode, batch), one file for each log."""
    rows: dict[str, list] = {}
    results = []
    for table, folders, written, mode, batch in entries:
        version = table.version() + 1
        rows.setdefault(table.log, []).append((table.base, version, list(folders), written, mode, batch))
        results.append(LoadResult(table.base, version, written))
    for log, own in rows.items():
        spark = entries[0][0]._spark
        spark.createDataFrame(own, LOG_SCHEMA).coalesce(1).write.mode("append").json(log)
    return results


def select_for(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Insert by column list: named columns in table order, cast to the table's types."""
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing for insert: {absent}")
    return df.to(nullable(schema))


def nullable(schema: T.StructType) -> T.StructType:
    """Same columns, all nullable: whether a value may be missing is the contract's check."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
