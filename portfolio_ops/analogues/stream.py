"""The continuous rating-fact load, drained over the events table."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portfolio_ops.analogues.jobs import rating_interim
from portfolio_ops.analogues.registry import Tables, query
from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.operators.stored_keys import StoredKeys
from portfolio_ops.schemas import KEY_INDUSTRY
from portfolio_ops.session import shared_dir
from portfolio_ops.sources.snapshot import SnapshotTable
from portfolio_ops.streaming.key_industry import key_industry_stream


_SQL = """
SELECT event_type AS "BK_RATER_NAME", CAST(user_id AS VARCHAR) AS "BK_VERSION",
 CAST(event_id AS VARCHAR) AS "BK_RATING_ID", json_extract_string(props, '$.k') AS "KEY_INDUSTRY_KEY"
FROM events WHERE event_type <> 'error' AND json_extract_string(props, '$.k') IS NOT NULL"""


def _drained(t: Tables, parts: list[Column], with_keys: bool = False) -> DataFrame:
    """One drain of the events for each condition, each with a checkpoint of its own."""
    name = uuid.uuid4().hex
    run = os.path.join(shared_dir(t.spark), "streams", name)
    target = SnapshotTable(t.spark, f"{run}/table", KEY_INDUSTRY)
    keys = StoredKeys(t.spark, f"stream_keys_{name}", f"{run}/keys", fv.KEY_INDUSTRY_KEYS) if with_keys else None
    for k, part in enumerate(parts):
        events = (t.spark.readStream.schema(t.events.schema)
                  .option("pathGlobFilter", "events.parquet").parquet(t.folder))
        key_industry_stream(rating_interim(events.filter(part)), target, f"{run}/checkpoint{k}",
                            available_now=True, keys=keys).awaitTermination()
    return target.read().select("BK_RATER_NAME", "BK_VERSION", "BK_RATING_ID", "KEY_INDUSTRY_KEY")


@query("key_industry_stream", _SQL)
def drained_stream(t: Tables) -> DataFrame:
    return _drained(t, [F.lit(True)])


@query("key_industry_stream_restart", _SQL)
def restarted_stream(t: Tables) -> DataFrame:
    """The checkpoint is lost after the first events; the second stream reads all again."""
    return _drained(t, [F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"), F.lit(True)])


@query("key_industry_stream_bucketed", _SQL)
def bucketed_stream(t: Tables) -> DataFrame:
    """Two streams over the events, the second over all again; what is new is found in bucketed keys."""
    return _drained(t, [F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"), F.lit(True)], with_keys=True)
