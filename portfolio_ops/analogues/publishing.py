"""Published tables read back: refresh, appends with counts, tables that switch together."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.analogues.registry import Tables, double, query
from portfolio_ops.operators.contract import Contract
from portfolio_ops.session import shared_dir
from portfolio_ops.sources.landing import with_lineage, with_surrogate
from portfolio_ops.sources.registry import Registry
from portfolio_ops.sources.snapshot import Load, SnapshotTable, publish_together


def _folder(t: Tables) -> str:
    return os.path.join(shared_dir(t.spark), "published", uuid.uuid4().hex)


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", double("o_totalprice"))


@query("publish_refresh", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice
FROM orders WHERE o_orderstatus <> 'F'""")
def refresh(t: Tables) -> DataFrame:
    """A full refresh by a query over the stored table itself."""
    rows = _orders(t)
    table = SnapshotTable(t.spark, _folder(t), rows.schema)
    key = Contract(("o_orderkey",), {"PK": ("o_orderkey",)})
    table.publish(rows, contract=key)
    table.publish(table.read().filter("o_orderstatus <> 'F'"), contract=key)
    table.vacuum()
    return table.read()


@query("publish_append_count", """
SELECT o_orderstatus AS part, count(*) AS rows_inserted,
 (SELECT count(*) FROM orders o2 WHERE o2.o_orderstatus <= o.o_orderstatus) AS rows_stored
FROM orders o GROUP BY o_orderstatus""")
def append_count(t: Tables) -> DataFrame:
    """An append for each status: rows reported and rows stored after it."""
    rows = _orders(t)
    table = SnapshotTable(t.spark, _folder(t), rows.schema)
    out = []
    for part in ("F", "O", "P"):
        result = table.publish(rows.filter(F.col("o_orderstatus") == part), "append",
                               Contract(unique={"PK": ("o_orderkey",)}))
        if result.rows_inserted:
            out.append((part, result.rows_inserted, table.read().count()))
    return t.spark.createDataFrame(out, "part string, rows_inserted long, rows_stored long")


@query("publish_together", """
SELECT 'orders' AS table_name, count(*) AS n FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'customer', count(*) FROM customer""")
def together(t: Tables) -> DataFrame:
    """Two tables with one log, published twice; the second refresh replaces both."""
    folder = _folder(t)
    orders, customer = _orders(t), t.customer.select("c_custkey", "c_name")
    first, second = (SnapshotTable(t.spark, f"{folder}/{n}", df.schema, f"{folder}/log")
                     for n, df in (("orders", orders), ("customer", customer)))
    publish_together([Load(first, orders), Load(second, customer.limit(1))])
    publish_together([Load(first, orders.filter("o_orderstatus <> 'F'")), Load(second, customer)])
    return first.read().select(F.lit("orders").alias("table_name")).union(
        second.read().select(F.lit("customer"))).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))


@query("landed_rows", """
SELECT event_id, 'run 1' AS process_id, 'events feed' AS source_name, 'STG' AS created_from,
 1 AS has_audit, 1 AS rows_of_id FROM events""")
def landed(t: Tables) -> DataFrame:
    """Rows read by a three-part name, with a generated id and the audit columns."""
    source = Registry(t.spark, {"[LAKE].[Raw Data].[EVENTS]": f"{t.folder}/events.parquet"})
    rows = with_surrogate(source.read_table("lake.[raw data].events"), "_id")
    rows = with_lineage(rows, "run 1", "events feed", "STG")
    copies = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("rows_of_id"))
    audit = F.col("created_at_ts").isNotNull() & F.col("created_by").isNotNull()
    return rows.join(copies, "_id").select(
        "event_id", "process_id", "source_name", "created_from",
        audit.cast("int").alias("has_audit"), "rows_of_id")
