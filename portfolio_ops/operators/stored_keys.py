"""Keys of a stored table in buckets, so that a batch finds its new rows without reading them all.

``not_stored`` reduces the whole stored table to its distinct keys for each batch. Here the key
hashes lie in a bucketed Parquet table of their own: a join needs no exchange of it, and a small
batch reads only the buckets that its keys fall in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portfolio_ops.functions.hashing import hash_key
from portfolio_ops.sources.registry import quoted

HASH = "key_hash"


class StoredKeys:
    """Key hashes at ``path``, known to the catalogue as ``table``.

    A row whose key has a missing part is never stored and always new. ``pruned_below`` bounds
    the key hashes that a batch may bring to the driver to prune buckets; a larger batch joins all
    of them, as it touches them anyway. Adding a key again changes no answer.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, keys: Sequence[str], buckets: int = 64,
                 pruned_below: int = 1000):
        self.table, self.keys = quoted(table), list(keys)
        self.buckets, self.pruned_below = buckets, pruned_below
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({HASH} STRING) USING PARQUET "
                  f"CLUSTERED BY ({HASH}) SORTED BY ({HASH}) INTO {buckets} BUCKETS LOCATION '{location}'")

    def _hashed(self, df: DataFrame) -> Column:
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        return F.when(complete, hash_key(df, self.keys))

    def add(self, rows: DataFrame) -> None:
        """Remember the keys of ``rows``: one file for each bucket they fall in."""
        found = rows.select(self._hashed(rows).alias(HASH)).filter(F.col(HASH).isNotNull()).distinct()
        found.repartition(self.buckets, HASH).write.insertInto(self.table)

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose key is not stored, copies inside the batch included."""
        keyed = batch.withColumn(HASH, self._hashed(batch))
        session = batch.sparkSession        # a micro-batch has a session of its own
        session.catalog.refreshTable(self.table)     # its list of files may be older than the last add
        stored = session.table(self.table)
        few = [r[0] for r in keyed.select(HASH).distinct().limit(self.pruned_below + 1).collect()]
        if len(few) <= self.pruned_below:
            stored = stored.filter(F.col(HASH).isin([h for h in few if h is not None]))
        return keyed.join(stored, HASH, "left_anti").select(*batch.columns)
