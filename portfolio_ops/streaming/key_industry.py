"""Continuous form of the rating-fact load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from portfolio_ops.operators.stored_keys import StoredKeys
from portfolio_ops.plans.key_industry import extract_key_industry, key_industry
from portfolio_ops.sources.snapshot import SnapshotTable


def load_batch(interim: DataFrame, target: SnapshotTable, batch: str, keys: StoredKeys | None = None) -> None:
    """Append the batch's new keys once; a replayed batch is recognised by its id.

    With ``keys`` the stored table is not read. Rows are published before their keys are added;
    a batch that was lost in between adds its keys when it is replayed.
    """
    if keys is None:
        if not target.has_batch(batch):
            target.publish(key_industry(interim, target.read()), mode="append", batch=batch)
        return
    rows = extract_key_industry(interim)
    if not target.has_batch(batch):
        target.publish(keys.new_rows(rows), mode="append", batch=batch)
    keys.add(rows)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that Spark gave the query when its checkpoint was made; it lives as long as that."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def key_industry_stream(interim: DataFrame, target: SnapshotTable, checkpoint: str,
                        available_now: bool = False, keys: StoredKeys | None = None) -> StreamingQuery:
    """Start loading a streaming ``interim``.

    "New" is decided against the stored table, so no watermark or state is kept; with ``keys``
    against its bucketed keys, of which a micro-batch reads only its buckets. The
    checkpoint remembers offsets. A published batch carries the query's id and its number,
    so one that was written but not acknowledged is a no-op when it is replayed, while a
    query with a new checkpoint, which counts from 0 again, is never mistaken for it.
    """
    def each(df: DataFrame, batch_id: int) -> None:
        load_batch(df, target, f"{query_id(df.sparkSession, checkpoint)}-{batch_id}", keys)

    writer = interim.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
