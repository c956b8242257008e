"""Hub, link and satellite loads on the driver tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.analogues.registry import Tables, flat, query
from portfolio_ops.operators.history import Columns, History, TwoPartSatellite, restitch
from portfolio_ops.operators.vault import satellite_as_of
from portfolio_ops.plans import vault_model
from portfolio_ops.operators.migrate import migrate
from portfolio_ops.plans.publish import publish_vault
from portfolio_ops.plans.vault_load import load_migrated, load_table, load_vault
from portfolio_ops.session import shared_dir, stage
from portfolio_ops.sources.snapshot import SnapshotTable, nullable


def _empty(t: Tables, name: str) -> DataFrame:
    return t.spark.createDataFrame([], nullable(vault_model.schema(name)))


def _technical(rows: DataFrame, load: str) -> DataFrame:
    return rows.withColumns({"LOAD_DATETIME": F.col(load).cast("timestamp_ntz"),
                             "RECORD_SOURCE_NAME": F.lit("file"), "SOURCE_SYSTEM_NAME": F.lit("crm")})


def _md5(*parts: str) -> str:
    """SQL of the hash key: length-prefixed parts, '-' for a missing one."""
    return "md5(" + " || '|' || ".join(
        f"coalesce(length({p}) || ':' || {p}, '-')" for p in parts) + ")"


def policy_source(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("POLICY_REFERENCE_NK", F.concat(F.lit("C"), "o_custkey"))
    return _technical(rows, "o_orderdate")


def stored_policies(t: Tables) -> DataFrame:
    early = t.orders.filter(F.col("o_orderdate") < F.lit("1995-03-01").cast("timestamp_ntz"))
    source = _technical(early.withColumn("POLICY_REFERENCE_NK", F.concat(F.lit("C"), "o_custkey")), "o_orderdate")
    return load_table("HUB_POLICY", _empty(t, "HUB_POLICY"), source)


@query("hub_load", f"""
WITH o AS (SELECT *, 'C' || o_custkey AS nk FROM orders)
SELECT {_md5("nk")} AS "HUB_POLICY_HK", nk AS "POLICY_REFERENCE_NK", strftime(min(o_orderdate), '%Y-%m-%d') AS "LOAD_DATETIME"
FROM o WHERE nk NOT IN (SELECT nk FROM o WHERE o_orderdate < TIMESTAMP '1995-03-01') GROUP BY nk""")
def hub(t: Tables) -> DataFrame:
    rows = load_table("HUB_POLICY", stored_policies(t), policy_source(t))
    return flat(rows.select("HUB_POLICY_HK", "POLICY_REFERENCE_NK", "LOAD_DATETIME"))


def broker_source(t: Tables) -> DataFrame:
    rows = t.customer.withColumns({
        "CRM_ID": F.nullif("c_nationkey", F.lit(3)).cast("string"), "LLOYDS_ID": F.col("c_mktsegment"),
        "BROKER_NAME": F.when(F.col("c_acctbal") > 0, "positive"), "_load": F.lit("2020-01-01")})
    nk = F.concat_ws("/", "CRM_ID", "LLOYDS_ID", "BROKER_NAME")
    return _technical(rows.withColumn("BROKER_NK", nk), "_load")


@query("hub_composite_key", f"""
WITH c AS (SELECT CAST(nullif(c_nationkey, 3) AS VARCHAR) AS a, c_mktsegment AS b, CASE WHEN c_acctbal>0 THEN 'positive' END AS n, 'crm' AS s FROM customer)
SELECT DISTINCT {_md5("a", "b", "n", "s")} AS "HUB_BROKER_HK", a AS "CRM_ID", b AS "LLOYDS_ID", n AS "BROKER_NAME" FROM c""")
def broker_hub(t: Tables) -> DataFrame:
    rows = load_table("HUB_BROKER", _empty(t, "HUB_BROKER"), broker_source(t))
    return rows.select("HUB_BROKER_HK", "CRM_ID", "LLOYDS_ID", "BROKER_NAME")


@query("link_load", f"""
WITH l AS (SELECT 'C' || o_custkey AS a, 'S' || l_suppkey AS b, min(o_orderdate) AS d FROM lineitem JOIN orders ON o_orderkey=l_orderkey GROUP BY 1, 2),
k AS (SELECT {_md5("a")} AS ka, {_md5("b")} AS kb, d FROM l)
SELECT {_md5("ka", "kb")} AS "LNK_POLICY_POLICY_LINE_HK", ka AS "HUB_POLICY_HK", kb AS "HUB_POLICY_LINE_HK",
 strftime(d, '%Y-%m-%d') AS "LOAD_DATETIME" FROM k""")
def link(t: Tables) -> DataFrame:
    from portfolio_ops.operators.vault import with_hub_key
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("C"), "o_custkey").alias("_policy"), F.concat(F.lit("S"), "l_suppkey").alias("_line"),
        "o_orderdate")
    rows = with_hub_key(with_hub_key(rows, ["_policy"], "HUB_POLICY_HK"), ["_line"], "HUB_POLICY_LINE_HK")
    made = load_table("LNK_POLICY_POLICY_LINE", _empty(t, "LNK_POLICY_POLICY_LINE"),
                      _technical(rows, "o_orderdate"))
    return flat(made.select("LNK_POLICY_POLICY_LINE_HK", "HUB_POLICY_HK", "HUB_POLICY_LINE_HK", "LOAD_DATETIME"))


def premium_source(t: Tables) -> DataFrame:
    """Status history of a customer: one version candidate per distinct order date."""
    daily = (t.orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderstatus").alias("_status"))
             .withColumns({"HUB_POLICY_HK": F.md5(F.col("o_custkey").cast("string")),
                           "POLICY_STATUS_NAME": F.col("_status"), "PROCESS_ID": F.lit(1)}))
    absent = [f for f in vault_model.schema("SAT_POLICY_DETAIL_RAW").fields
              if f.name in vault_model.TABLES["SAT_POLICY_DETAIL_RAW"].attribute_names
              and f.name != "POLICY_STATUS_NAME"]
    return _technical(daily.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}), "o_orderdate")


FIRST_LOAD = "1998-01-01"


def satellite(t: Tables) -> DataFrame:
    """Two loads: rows up to a date, then the whole source again."""
    name, source = "SAT_POLICY_DETAIL_RAW", stage(premium_source(t), "versions")
    early = source.filter(F.col("LOAD_DATETIME") < F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    first = stage(load_table(name, _empty(t, name), early), "satellite")
    return load_table(name, first, source)


_SATELLITE = """
WITH d AS (SELECT o_custkey AS k, o_orderdate AS seen, max(o_orderstatus) AS st FROM orders GROUP BY 1, 2),
v AS (SELECT * FROM d QUALIFY st IS DISTINCT FROM lag(st) OVER (PARTITION BY k ORDER BY seen)),
e AS (SELECT *, lead(seen) OVER (PARTITION BY k ORDER BY seen) AS fin FROM v)
"""


@query("satellite_history", _SATELLITE + """
SELECT md5(CAST(k AS VARCHAR)) AS "HUB_POLICY_HK", strftime(seen, '%Y-%m-%d') AS "LOAD_DATETIME", st AS "POLICY_STATUS_NAME",
 strftime(coalesce(fin, TIMESTAMP '9999-12-31'), '%Y-%m-%d') AS "END_DATETIME", CAST(fin IS NULL AS BIGINT) AS "IS_CURRENT_FLAG" FROM e""")
def history(t: Tables) -> DataFrame:
    return flat(satellite(t).select("HUB_POLICY_HK", "LOAD_DATETIME", "POLICY_STATUS_NAME", "END_DATETIME",
                                    "IS_CURRENT_FLAG"))


_HISTORY = _SATELLITE + """
SELECT md5(CAST(k AS VARCHAR)) AS "HUB_POLICY_HK", strftime(seen, '%Y-%m-%d') AS "LOAD_DATETIME", st AS "POLICY_STATUS_NAME",
 strftime(coalesce(fin, TIMESTAMP '9999-12-31'), '%Y-%m-%d') AS "END_DATETIME", CAST(fin IS NULL AS BIGINT) AS "IS_CURRENT_FLAG" FROM e"""
_HISTORY_COLUMNS = ["HUB_POLICY_HK", "LOAD_DATETIME", "POLICY_STATUS_NAME", "END_DATETIME", "IS_CURRENT_FLAG"]


def _disordered(t: Tables) -> tuple[Columns, list[DataFrame]]:
    """The source in three batches: a middle, what is newer with every third day of what is older, then all."""
    name, source = "SAT_POLICY_DETAIL_RAW", stage(premium_source(t), "versions")
    day = F.datediff(F.col("LOAD_DATETIME"), F.lit("1992-01-01").cast("date"))
    middle = day.between(800, 1600)
    batches = [source.filter(middle), source.filter(~middle & ((day > 1600) | (day % 3 == 0))), source]
    return Columns("HUB_POLICY_HK", vault_model.TABLES[name].attribute_names), batches


@query("satellite_any_order", _HISTORY)
def any_order(t: Tables) -> DataFrame:
    """Late rows become versions at their place: three disordered batches give the sorted history."""
    names, batches = _disordered(t)
    versions = _empty(t, "SAT_POLICY_DETAIL_RAW")
    made = History(versions, versions.drop("END_DATETIME", "IS_CURRENT_FLAG"))
    for batch in batches:
        made = restitch(made, batch, names)
        made = History(stage(made.versions, "history"), stage(made.confirmed, "confirmed"))
    return flat(made.versions.select(*_HISTORY_COLUMNS))


@query("satellite_two_parts", _HISTORY)
def two_parts(t: Tables) -> DataFrame:
    """The same batches into a table of closed and current parts, partitioned by key bucket."""
    names, batches = _disordered(t)
    table = TwoPartSatellite(t.spark, os.path.join(shared_dir(t.spark), "published", uuid.uuid4().hex),
                             vault_model.schema("SAT_POLICY_DETAIL_RAW"), names, buckets=8)
    for batch in batches:
        table.load(batch)
    return flat(table.read().select(*_HISTORY_COLUMNS))


@query("satellite_as_of", _SATELLITE + """
SELECT md5(CAST(k AS VARCHAR)) AS "HUB_POLICY_HK", st AS "POLICY_STATUS_NAME" FROM e
WHERE seen <= TIMESTAMP '1999-01-01' AND (fin IS NULL OR fin > TIMESTAMP '1999-01-01')""")
def as_of(t: Tables) -> DataFrame:
    rows = satellite_as_of(satellite(t), F.lit("1999-01-01").cast("timestamp_ntz"))
    return rows.select("HUB_POLICY_HK", "POLICY_STATUS_NAME")


_VERSIONS = _SATELLITE + """
SELECT md5(CAST(k AS VARCHAR)) AS "HUB_POLICY_HK", strftime(seen, '%Y-%m-%d') AS "LOAD_DATETIME", st AS "POLICY_STATUS_NME",
 strftime(seen, '%Y-%m-%d') AS "EVENT_TIMESTAMP", CAST({run} AS DOUBLE) AS "PROCESS_ID",
 CAST(fin IS NULL AS BIGINT) AS "IS_CURRENT_FLAG" FROM e"""
_MIGRATED = ["HUB_POLICY_HK", "LOAD_DATETIME", "POLICY_STATUS_NME", "EVENT_TIMESTAMP", "PROCESS_ID",
             "IS_CURRENT_FLAG"]


@query("vault_migration", _VERSIONS.format(run="1"))
def migration(t: Tables) -> DataFrame:
    """The whole plan over all 24 tables, of which one is loaded."""
    tables = {n: _empty(t, n) for n in vault_model.TABLES}
    tables["SAT_POLICY_DETAIL_RAW"] = satellite(t)
    fill = {"PROCESS_ID": F.lit(1), "EVENT_TIMESTAMP": F.col("LOAD_DATETIME"), "ROW_DIFF_HK": F.unhex("HASH_DIFF")}
    out = migrate(tables, vault_model.migration(as_declared=True), {n: fill for n in tables})
    assert set(out) == {vault_model.end_name(n) for n in vault_model.TABLES}
    return flat(out[vault_model.end_name("SAT_POLICY_DETAIL_RAW")].select(*_MIGRATED))


@query("vault_load_migrated", _VERSIONS.format(
    run=f"CASE WHEN seen < TIMESTAMP '{FIRST_LOAD}' THEN 7 ELSE 8 END"))
def migrated_load(t: Tables) -> DataFrame:
    """Two loads into the migrated satellite; stored versions keep their process."""
    name, source = "SAT_POLICY_DETAIL_RAW", stage(premium_source(t), "versions")
    stored = t.spark.createDataFrame([], nullable(vault_model.migrated_schema(name)))
    early = source.filter(F.col("LOAD_DATETIME") < F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    first = stage(load_migrated(name, stored, early, F.col("LOAD_DATETIME"), F.lit(7)).rows, "satellite")
    return flat(load_migrated(name, first, source, F.col("LOAD_DATETIME"), F.lit(8)).rows.select(*_MIGRATED))


@query("vault_load_all", """
SELECT 'HUB_POLICY' AS table_name, count(DISTINCT o_custkey) AS n FROM orders
UNION ALL SELECT 'HUB_POLICY_LINE', count(DISTINCT l_suppkey) FROM lineitem JOIN orders ON o_orderkey=l_orderkey
UNION ALL SELECT 'LNK_POLICY_POLICY_LINE', count(*) FROM (SELECT DISTINCT o_custkey, l_suppkey FROM lineitem JOIN orders ON o_orderkey=l_orderkey)
UNION ALL SELECT 'SAT_POLICY_DETAIL_RAW', count(*) FROM (SELECT o_custkey, max(o_orderstatus) AS st, o_orderdate FROM orders GROUP BY 1, 3
 QUALIFY st IS DISTINCT FROM lag(st) OVER (PARTITION BY o_custkey ORDER BY o_orderdate))""")
def load_all(t: Tables) -> DataFrame:
    """Hubs, a link and a satellite in one load: rows of each table."""
    from portfolio_ops.operators.vault import with_hub_key
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    names = {"POLICY_REFERENCE_NK": F.concat(F.lit("C"), "o_custkey"),
             vault_model.TABLES["HUB_POLICY_LINE"].natural_key: F.concat(F.lit("S"), "l_suppkey")}
    keyed = lines.withColumns(names)
    for column, key in zip(names, ("HUB_POLICY_HK", "HUB_POLICY_LINE_HK")):
        keyed = with_hub_key(keyed, [column], key)
    sources = {"HUB_POLICY": policy_source(t), "HUB_POLICY_LINE": _technical(keyed, "o_orderdate"),
               "LNK_POLICY_POLICY_LINE": _technical(keyed, "o_orderdate"),
               "SAT_POLICY_DETAIL_RAW": premium_source(t)}
    loaded = load_vault({n: _empty(t, n) for n in sources}, sources)
    counts = [loaded[n].select(F.lit(n).alias("table_name")) for n in sources]
    whole = counts[0]
    for part in counts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))


@query("vault_late_rows", f"""
WITH d AS (SELECT 'C' || o_custkey AS nk, o_orderdate AS seen, max(o_orderstatus) AS st FROM orders GROUP BY 1, 2),
s AS (SELECT *, seen < TIMESTAMP '1995-03-01' AND max(seen) OVER (PARTITION BY nk) >= TIMESTAMP '1995-03-01' AS late FROM d),
v AS (SELECT * FROM s WHERE NOT late QUALIFY st IS DISTINCT FROM lag(st) OVER (PARTITION BY nk ORDER BY seen))
SELECT 'loaded' AS place, {_md5("nk")} AS "HUB_POLICY_HK", strftime(seen, '%Y-%m-%d') AS "LOAD_DATETIME", st AS "POLICY_STATUS_NAME" FROM v
UNION ALL SELECT 'late', {_md5("nk")}, strftime(seen, '%Y-%m-%d'), st FROM s WHERE late""")
def late(t: Tables) -> DataFrame:
    """Rows from a date on are published first, then the whole source twice: what is older than a
    stored version lies in the table of late rows, once."""
    from portfolio_ops.operators.vault import with_hub_key
    name = "SAT_POLICY_DETAIL_RAW"
    late_name = vault_model.late_name(name)
    rows = premium_source(t).withColumn("POLICY_REFERENCE_NK", F.concat(F.lit("C"), "o_custkey"))
    source = stage(with_hub_key(rows, ["POLICY_REFERENCE_NK"], "HUB_POLICY_HK"), "versions")
    folder = os.path.join(shared_dir(t.spark), "published", uuid.uuid4().hex)
    schemas = {"HUB_POLICY": vault_model.schema("HUB_POLICY"), name: vault_model.schema(name),
               late_name: vault_model.late_schema(name)}
    targets = {n: SnapshotTable(t.spark, f"{folder}/{n}", nullable(s), f"{folder}/log") for n, s in schemas.items()}
    recent = source.filter(F.col("LOAD_DATETIME") >= F.lit("1995-03-01").cast("timestamp_ntz"))
    for batch in (recent, source, source):
        publish_vault(targets, {"HUB_POLICY": batch, name: batch})
    columns = ["HUB_POLICY_HK", "LOAD_DATETIME", "POLICY_STATUS_NAME"]
    loaded, held = (targets[n].read().select(F.lit(place).alias("place"), *columns)
                    for n, place in ((name, "loaded"), (late_name, "late")))
    return flat(loaded.unionByName(held))
