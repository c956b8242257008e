"""Single operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.analogues.registry import Tables, day, double, flat, money, query
from portfolio_ops.functions import exprs as x
from portfolio_ops.functions.hashing import row_hash
from portfolio_ops.operators.change import (
    assign_by_class, drop_superseded, fill_from_first, fill_from_group_max, insert_new,
    mapping_by_class, merge_by_hash, merge_snapshot, not_stored, total_per_group)
from portfolio_ops.operators.contract import Contract, ForeignKey, check_contract
from portfolio_ops.operators.dedupe import first_per_key, keep_max_key, latest_per_key
from portfolio_ops.operators.filters import delete_where, only_active, required_keys
from portfolio_ops.operators.focus import trifocus_code, trifocus_name
from portfolio_ops.operators.lookups import lookup, map_codes
from portfolio_ops.operators.migrate import TableMigration, migrate_table
from portfolio_ops.operators.ordered import (
    GROUP_ROWS, Ordered, balance_columns, ordered_groups, reverse_position)
from portfolio_ops.operators.ranking import global_dense_rank
from portfolio_ops.plans.homeowners import derive_transactions


# -- ranking and windows ----------------------------------------------------

@query("global_dense_rank", """
SELECT o_orderkey, dense_rank() OVER (ORDER BY o_custkey NULLS LAST, st NULLS LAST) AS group_id
FROM (SELECT *, nullif(o_orderstatus, 'P') AS st FROM orders)""")
def dense_rank(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("_status", F.nullif("o_orderstatus", F.lit("P")))
    return global_dense_rank(rows, ["o_custkey", "_status"], "group_id").select("o_orderkey", "group_id")


@query("ordered_positions", """
SELECT o_orderkey, row_number() OVER w AS position,
 count(*) OVER (PARTITION BY o_custkey) + 1 - row_number() OVER w AS reverse_position
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey)""")
def positions(t: Tables) -> DataFrame:
    spec = Ordered(["o_custkey"], [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey").asc_nulls_last()],
                   position="position", group_size="_size")
    rows = ordered_groups(t.orders, spec)
    return rows.select("o_orderkey", "position", reverse_position("position", "_size").alias("reverse_position"))


_BALANCE_SQL = """
WITH l AS (SELECT *, CAST(l_quantity AS DECIMAL(19,4)) AS carried, CAST(l_extendedprice AS DECIMAL(19,4)) AS inflow,
  CASE WHEN l_returnflag='A' THEN CAST(l_tax AS DECIMAL(19,4)) ELSE 0 END AS outflow FROM lineitem),
f AS (SELECT *, lag(carried, 1, 0) OVER w + inflow - outflow AS flow FROM l
 WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey))
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CAST(sum(flow) OVER (PARTITION BY l_suppkey
 ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance FROM f"""


@query("running_balance", _BALANCE_SQL)
def balance(t: Tables) -> DataFrame:
    return _running_balance(t, GROUP_ROWS)


@query("running_balance_segmented", _BALANCE_SQL)
def balance_segmented(t: Tables) -> DataFrame:
    """Suppliers of more than 300 lines are cut into segments."""
    return _running_balance(t, 300)


def _running_balance(t: Tables, group_rows: int) -> DataFrame:
    outflow = F.when(F.col("l_returnflag") == "A", money("l_tax")).otherwise(F.lit(0).cast(x.MONEY))
    rows = t.lineitem.withColumn("_carried", money("l_quantity"))
    flows, running = balance_columns({"balance": ("_carried", money("l_extendedprice") - outflow)})
    order = [F.col(n).asc_nulls_last() for n in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")]
    rows = ordered_groups(rows.withColumns(flows), Ordered(["l_suppkey"], order, running=running),
                          group_rows, sized_by=t.lineitem)
    return rows.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                       double(F.col("_run_balance") - F.col("_carried"), "balance"))


@query("previous_and_next", """
SELECT o_orderkey, lag(o_orderkey, 1, -1) OVER w AS previous_order, lead(o_orderkey) OVER w AS next_order
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def neighbours(t: Tables) -> DataFrame:
    spec = Ordered(["o_custkey"], [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey").asc_nulls_last()],
                   lags={"previous_order": "o_orderkey"}, leads={"next_order": "o_orderkey"},
                   missing={"previous_order": -1})
    return ordered_groups(t.orders, spec).select("o_orderkey", "previous_order", "next_order")


# -- one row per key --------------------------------------------------------

@query("latest_per_key", """
SELECT o_custkey, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) = 1""")
def latest(t: Tables) -> DataFrame:
    return latest_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("first_or_none", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey) AS rn
 FROM orders WHERE o_orderpriority='1-URGENT')
SELECT c_custkey, o_orderkey AS first_order, CAST(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END AS BIGINT) AS opening
FROM customer LEFT JOIN r ON o_custkey=c_custkey WHERE coalesce(rn, 1) = 1""")
def first_or_none(t: Tables) -> DataFrame:
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    first = first_per_key(urgent, ["o_custkey"], [F.col("o_orderdate").desc_nulls_first(),
                                                  F.col("o_orderkey").asc_nulls_last()])
    rows = t.customer.join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows.select("c_custkey", F.col("o_orderkey").alias("first_order"),
                       F.col("o_orderkey").isNull().cast("long").alias("opening"))


@query("source_priority_dedupe", """
WITH p AS (SELECT *, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 WHEN o_orderpriority='3-MEDIUM' THEN 2 ELSE 3 END AS pri FROM orders)
SELECT o_custkey, o_orderkey, CAST(pri AS BIGINT) AS priority FROM p
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY pri, o_orderpriority, o_orderkey) = 1""")
def priority_dedupe(t: Tables) -> DataFrame:
    priority = (F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1)
                .when(F.col("o_orderpriority") == "3-MEDIUM", 2).otherwise(3))
    rows = t.orders.withColumn("priority", priority.cast("long"))
    return first_per_key(rows, ["o_custkey"], [F.col("priority").asc_nulls_first(),
                                               F.col("o_orderpriority").asc_nulls_first(),
                                               F.col("o_orderkey").asc_nulls_first()]
                         ).select("o_custkey", "o_orderkey", "priority")


@query("keep_max_key", """
WITH o AS (SELECT o_orderkey, nullif(o_custkey, 0) AS ref, CASE WHEN o_orderstatus<>'P' THEN CAST(o_orderkey AS VARCHAR) END AS k FROM orders)
SELECT o_orderkey, ref, k FROM o QUALIFY ref IS NULL OR k IS NULL OR k = max(k) OVER (PARTITION BY ref)""")
def max_key(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.nullif("o_custkey", F.lit(0)).alias("ref"),
                           F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("k"))
    return keep_max_key(rows, "ref", "k")


# -- changes ----------------------------------------------------------------

_HASHED = ["o_orderkey", "o_custkey", "o_orderstatus", "price", "o_orderdate"]
_SHA = """sha256(coalesce(CAST(o_orderkey AS VARCHAR),'NULL') || '#' || coalesce(CAST(o_custkey AS VARCHAR),'NULL') || '#' ||
 coalesce(nullif({st},'P'),'NULL') || '#' || coalesce(CAST(CAST({price} AS DECIMAL(19,4)) AS VARCHAR),'NULL') || '#' ||
 coalesce(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000+00:00'),'NULL'))"""


def _hashed(rows: DataFrame) -> DataFrame:
    shaped = rows.select("o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
                         money("o_totalprice").alias("price"), "o_orderdate", "o_orderpriority")
    return shaped.withColumn("h", row_hash(shaped, _HASHED))


@query("row_hash", f"SELECT o_orderkey, {_SHA.format(st='o_orderstatus', price='o_totalprice')} AS h FROM orders")
def hashes(t: Tables) -> DataFrame:
    return flat(_hashed(t.orders).select("o_orderkey", "h"))


_TARGET_PRICE = "CASE WHEN o_orderstatus='F' THEN o_totalprice + 1 ELSE o_totalprice END"


_MERGED = f"""
WITH tgt AS (SELECT *, {_TARGET_PRICE} AS price, 'old' AS tag, 'old' AS made FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
src AS (SELECT *, o_totalprice AS price, 'new' AS tag, 'new' AS made FROM orders WHERE o_orderdate >= TIMESTAMP '1996-06-01'),
t AS (SELECT o_orderkey, tag, made, o_orderpriority, CAST(price AS DECIMAL(19,4)) AS price, {_SHA.format(st='o_orderstatus', price='price')} AS h FROM tgt),
s AS (SELECT o_orderkey, tag, made, o_orderpriority, CAST(price AS DECIMAL(19,4)) AS price, {_SHA.format(st='o_orderstatus', price='price')} AS h FROM src)
SELECT s.o_orderkey, CASE WHEN t.h IS NULL OR t.h<>s.h THEN s.tag ELSE t.tag END AS tag, coalesce(t.made, s.made) AS made,
 CAST(CASE WHEN t.h IS NULL OR t.h<>s.h THEN s.price ELSE t.price END AS DOUBLE) AS price
FROM s LEFT JOIN t ON t.o_orderkey=s.o_orderkey"""


def _merge_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    def limit(day_text: str):
        return F.lit(day_text).cast("timestamp_ntz")
    old = t.orders.filter(F.col("o_orderdate") < limit("2000-01-01")).withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")))
    new = t.orders.filter(F.col("o_orderdate") >= limit("1996-06-01"))

    def tagged(rows: DataFrame, tag: str) -> DataFrame:
        return _hashed(rows).withColumns({"tag": F.lit(tag), "made": F.lit(tag)})
    return tagged(old, "old"), tagged(new, "new")


_MERGE_UPDATES = ["o_custkey", "o_orderstatus", "price", "o_orderdate", "tag"]


@query("merge_snapshot", _MERGED)
def merge(t: Tables) -> DataFrame:
    merged = merge_snapshot(*_merge_sides(t), ["o_orderkey"], "h", _MERGE_UPDATES)
    return merged.select("o_orderkey", "tag", "made", double("price"))


@query("merge_by_hash", _MERGED)
def merge_hash_first(t: Tables) -> DataFrame:
    merged = merge_by_hash(*_merge_sides(t), ["o_orderkey"], "h", _MERGE_UPDATES)
    return merged.select("o_orderkey", "tag", "made", double("price"))


@query("insert_new", """
SELECT event_id, user_id FROM events e WHERE event_type<>'view' AND NOT EXISTS (
 SELECT 1 FROM events s WHERE s.event_type='view' AND s.user_id=e.user_id AND s.props=e.props)""")
def new_rows(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return insert_new(t.events.filter(kind == "view"), t.events.filter(kind != "view"),
                      ["user_id", "props"]).select("event_id", "user_id")


@query("anti_join_not_exists", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey=c_custkey AND o_orderpriority='1-URGENT')""")
def not_exists(t: Tables) -> DataFrame:
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return not_stored(t.customer, urgent, ["c_custkey"]).select("c_custkey", "c_name")


@query("drop_superseded", """
SELECT event_id, user_id, event_type FROM events e WHERE NOT (
 (event_type='view' AND EXISTS (SELECT 1 FROM events p WHERE p.user_id=e.user_id AND p.props=e.props AND p.event_type='purchase'))
 OR (event_type='click' AND EXISTS (SELECT 1 FROM events p WHERE p.user_id=e.user_id AND p.props=e.props AND p.event_type='signup')))""")
def superseded(t: Tables) -> DataFrame:
    rows = t.events.withColumn("ref", F.concat_ws("/", F.col("user_id").cast("string"), "props"))
    kept = drop_superseded(rows, rows, "ref", "event_type", [("view", "purchase"), ("click", "signup")])
    return kept.select("event_id", "user_id", "event_type")


# -- joins, fills, assignment -----------------------------------------------

@query("computed_key_lookup", """
SELECT c_custkey, n_name AS place FROM customer LEFT JOIN nation
 ON n_nationkey = CASE WHEN c_mktsegment='BUILDING' THEN CASE WHEN c_acctbal < 0 THEN 1 ELSE 2 END ELSE c_nationkey + 3 END""")
def computed_lookup(t: Tables) -> DataFrame:
    key = (F.when(F.col("c_mktsegment") == "BUILDING", F.when(F.col("c_acctbal") < 0, 1).otherwise(2))
           .otherwise(F.col("c_nationkey") + 3))
    return lookup(t.customer, t.nation, key, F.col("n_nationkey"), {"place": F.col("n_name")}
                  ).select("c_custkey", "place")


@query("group_sum_join", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS price,
 CAST(sum(CAST(l_extendedprice AS DECIMAL(19,4))) OVER (PARTITION BY l_orderkey) AS DOUBLE) AS order_total FROM lineitem""")
def group_sum(t: Tables) -> DataFrame:
    rows = total_per_group(t.lineitem, ["l_orderkey"], money("l_extendedprice"), "order_total")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       double(money("l_extendedprice"), "price"), double("order_total"))


@query("assign_by_class", """
WITH m AS (SELECT s_nationkey AS k, max(s_name) FILTER (s_name LIKE '%_1') AS a, max(s_name) FILTER (s_name LIKE '%_2') AS b,
 max(s_name) FILTER (s_name LIKE '%_3') AS c FROM supplier GROUP BY 1)
SELECT c_custkey, CASE WHEN c_mktsegment='BUILDING' THEN coalesce(b, 'old')
 WHEN c_mktsegment='MACHINERY' AND c_nationkey<12 THEN coalesce(a, c, 'old') WHEN c_mktsegment='MACHINERY' THEN coalesce(c, 'old')
 WHEN c_mktsegment LIKE 'F%' THEN coalesce(a, 'old') ELSE 'old' END AS assigned
FROM customer LEFT JOIN m ON k=c_nationkey""")
def by_class(t: Tables) -> DataFrame:
    mapping = mapping_by_class(t.supplier, "s_nationkey", "s_name",
                               {"_a": ["%_1"], "_b": ["%_2"], "_c": ["%_3"]})
    old, segment = F.lit("old"), F.col("c_mktsegment")
    rule = (F.when(segment == "BUILDING", F.coalesce("_b", old))
            .when((segment == "MACHINERY") & (F.col("c_nationkey") < 12), F.coalesce("_a", "_c", old))
            .when(segment == "MACHINERY", F.coalesce("_c", old))
            .when(segment.like("F%"), F.coalesce("_a", old)).otherwise(old))
    return assign_by_class(t.customer, mapping, F.col("c_nationkey"), "assigned", rule).select("c_custkey", "assigned")


@query("fill_from_group", """
WITH l AS (SELECT *, nullif(l_discount, 0.05) AS disc, CASE WHEN l_returnflag<>'N' THEN l_returnflag END AS flag FROM lineitem),
f AS (SELECT l_orderkey AS k, max({'d': disc, 'm': l_linestatus}) AS v FROM l WHERE l_linenumber=1 GROUP BY 1),
g AS (SELECT l_orderkey AS k, max(flag) AS v FROM l WHERE flag IS NOT NULL GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN disc IS NULL AND f.k IS NOT NULL THEN f.v.d ELSE disc END AS disc,
 CASE WHEN disc IS NULL AND f.k IS NOT NULL THEN f.v.m ELSE l_linestatus END AS status, coalesce(flag, g.v) AS flag
FROM l LEFT JOIN f ON f.k=l_orderkey LEFT JOIN g ON g.k=l_orderkey""".replace(
    "max({'d': disc, 'm': l_linestatus})",
    "arg_max({'d': disc, 'm': l_linestatus}, {'n': disc IS NOT NULL, 'd': coalesce(disc, 0), 'm': l_linestatus})"))
def fills(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             F.nullif("l_discount", F.lit(0.05)).alias("disc"),
                             F.col("l_linestatus").alias("status"),
                             F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"))
    rows = fill_from_first(rows, "l_orderkey", F.col("l_linenumber") == 1, "disc", ["disc", "status"])
    return fill_from_group_max(rows, "l_orderkey", "flag")


# -- unions and currency ----------------------------------------------------

@query("dummy_rows_union", """
SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, 'line' AS kind, l_quantity AS qty FROM lineitem WHERE l_returnflag='A'
UNION ALL
SELECT o_orderkey, 0, 'opening', 0 FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey=o_orderkey AND l_returnflag='A')""")
def dummies(t: Tables) -> DataFrame:
    lines = t.lineitem.filter(F.col("l_returnflag") == "A").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("n"),
        F.lit("line").alias("kind"), F.col("l_quantity").alias("qty"))
    opening = not_stored(t.orders.select(F.col("o_orderkey").alias("k")), lines, ["k"]).select(
        "k", F.lit(0).cast("long").alias("n"), F.lit("opening").alias("kind"), F.lit(0.0).alias("qty"))
    return lines.unionByName(opening)


@query("reporting_currency_fold", """
WITH c AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(19,4)) AS bal, CASE c_mktsegment WHEN 'BUILDING' THEN 'EUR' WHEN 'MACHINERY' THEN 'GBP'
  ELSE 'R' || n_regionkey END AS ccy, CASE WHEN c_nationkey=3 THEN 0 ELSE 1.5 END AS grp FROM customer JOIN nation ON n_nationkey=c_nationkey),
r AS (SELECT 'R' || n_regionkey AS code, CAST(1.0::DOUBLE/(n_nationkey+10) AS DECIMAL(19,6)) AS ratio FROM nation
 QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC)=1)
SELECT c_custkey, CASE WHEN ccy IN ('EUR','USD','CAD','GBP') THEN ccy ELSE 'USD' END AS currency, ccy AS source_currency,
 CAST(CAST(bal * CASE WHEN ccy IN ('EUR','USD','CAD','GBP') OR grp=0 THEN 1 ELSE ratio END AS DECIMAL(19,4)) AS DOUBLE) AS converted,
 CAST(CASE WHEN grp=0 THEN 1 ELSE grp END AS DOUBLE) AS rate,
 CAST(CASE WHEN c_custkey < 100 THEN -bal ELSE bal END AS DOUBLE) AS signed
FROM c LEFT JOIN r ON code=ccy""")
def currency(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    rows = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", money("c_acctbal").alias("balance"),
                    F.when(segment == "BUILDING", "EUR").when(segment == "MACHINERY", "GBP")
                    .otherwise(F.concat(F.lit("R"), "n_regionkey")).alias("source_currency"),
                    F.when(F.col("c_nationkey") == 3, 0.0).otherwise(1.5).cast(x.RATE).alias("group_rate")))
    rates = latest_per_key(t.nation, ["n_regionkey"], ["n_nationkey"]).select(
        F.concat(F.lit("R"), "n_regionkey").alias("code"),
        (F.lit(1) / (F.col("n_nationkey") + 10).cast(x.RATE)).cast(x.RATIO).alias("ratio"))
    rows = rows.join(rates, F.col("source_currency") == F.col("code"), "left")
    usd = x.settlement_to_usd("source_currency", "group_rate", "ratio")
    rows = rows.withColumns({
        "currency": x.reporting_currency("source_currency"),
        "converted": (F.col("balance") * usd).cast(x.MONEY),
        "rate": x.zero_to_one("group_rate"), "signed": F.col("balance")})
    rows = rows.withColumns(x.negate_where(["signed"], F.col("c_custkey") < 100))
    return rows.select("c_custkey", "currency", "source_currency", double("converted"), double("rate"),
                       double("signed"))


# -- scalar rules -----------------------------------------------------------

@query("code_map", """
SELECT c_custkey, coalesce(n_name, CAST(code AS VARCHAR)) AS place FROM
 (SELECT c_custkey, c_nationkey + 5 AS code FROM customer) LEFT JOIN nation ON n_nationkey=code""")
def codes(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", (F.col("c_nationkey") + 5).alias("code"))
    return map_codes(rows, "code", t.nation, "n_nationkey", "n_name", "place").select("c_custkey", "place")


@query("status_map", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Live' WHEN '2-HIGH' THEN 'Quote' WHEN '3-MEDIUM' THEN 'Cancelled' END AS status,
 CASE o_orderstatus WHEN 'F' THEN 'Florida' WHEN 'O' THEN 'OO' ELSE 'Pennsylvania' END AS place FROM orders""")
def statuses(t: Tables) -> DataFrame:
    text = (F.when(F.col("o_orderpriority") == "1-URGENT", "BOUND RENEWAL")
            .when(F.col("o_orderpriority") == "2-HIGH", "quoted")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "ERROR CORRECTION").otherwise("other"))
    state = (F.when(F.col("o_orderstatus") == "F", "FL").when(F.col("o_orderstatus") == "O", "OO")
             .otherwise("PA"))
    return t.orders.select("o_orderkey", x.map_section_status(text).alias("status"),
                           x.map_state(state).alias("place"))


@query("number_or_zero", """
SELECT event_id, CAST(CASE WHEN event_type='error' THEN 0 ELSE CAST(value AS DECIMAL(19,4)) END AS DOUBLE) AS amount FROM events""")
def numbers(t: Tables) -> DataFrame:
    text = (F.when(F.col("event_type") == "error", "n/a").otherwise(money("value").cast("string")))
    return t.events.select("event_id", double(x.numeric_or_zero(text), "amount"))


@query("first_of_month", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders""")
def months(t: Tables) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t.orders.select("o_orderkey", day(x.first_of_month(text), "month"))


@query("padded_suffix", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 CASE WHEN l_returnflag<>'N' THEN 'P' || l_orderkey END || '-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS section FROM lineitem""")
def suffix(t: Tables) -> DataFrame:
    reference = F.when(F.col("l_returnflag") != "N", F.concat(F.lit("P"), "l_orderkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             x.section_suffix(reference, "l_linenumber").alias("section"))


@query("transaction_derivation", """
SELECT 'O' || o_orderkey AS ref, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period,
 CAST(coalesce(CAST(o_totalprice AS DECIMAL(19,4)), 0) AS DOUBLE) AS premium,
 CAST(CASE WHEN o_orderstatus='F' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(19,4)) * CAST(0.125 AS DECIMAL(5,3)) END AS DOUBLE) AS commission FROM orders""")
def transactions(t: Tables) -> DataFrame:
    sections = t.orders.select(
        F.concat(F.lit("O"), "o_orderkey").alias("SectionReference"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("InceptionDate"),
        money("o_totalprice").alias("WrittenOrEstimatedPremium"),
        F.when(F.col("o_orderstatus") != "F", F.lit("12.5")).alias("ExternalAcquisitionCostPercentage"),
        F.lit("USD").alias("OriginalCurrency"), F.lit("USD").alias("SettlementCurrency"),
        F.lit(1).cast(x.MONEY).alias("OriginalToSettlementCurrencyRate"))
    made = derive_transactions(sections)
    return made.select(F.col("FK_Section").alias("ref"), day("AccountingPeriod", "period"),
                       double("ReceivedPremium", "premium"),
                       double("ExternalAcquisitionCostAmount", "commission"))


@query("filter_null_logic", """
SELECT d.doc_id, lang, CAST(quality AS BIGINT) AS quality FROM documents d LEFT JOIN labels l ON l.doc_id=d.doc_id
WHERE NOT coalesce(quality=0 AND lang<>'en', false) AND coalesce(toxic, 0)=0 AND source IS NOT NULL""")
def null_logic(t: Tables) -> DataFrame:
    rows = t.documents.join(t.labels.withColumnRenamed("doc_id", "_doc"), F.col("doc_id") == F.col("_doc"), "left")
    rows = delete_where(rows, (F.col("quality") == 0) & (F.col("lang") != "en"))
    rows = required_keys(only_active(rows, off=["toxic"]), ["source"])
    return rows.select("doc_id", "lang", F.col("quality").cast("long").alias("quality"))


# -- focus rules ------------------------------------------------------------

@query("trifocus_rules", """
WITH cd AS (SELECT CAST(p_partkey AS VARCHAR) || 'abcdefgh' AS ref, p_partkey, p_type, p_brand, p_size,
  CASE WHEN p_size < 25 THEN 'own' || p_size END AS own FROM part),
cob AS (SELECT DISTINCT p_type AS code, CASE p_type WHEN 'ECONOMY' THEN 'Specialty Lines' WHEN 'PROMO' THEN NULL ELSE 'Other' END AS dept FROM part),
foc AS (SELECT DISTINCT p_brand, 'area ' || p_brand AS area FROM part WHERE p_brand LIKE 'Brand#1%')
SELECT dept AS cob_dept, ref AS section_reference, substr(ref, 1, 8) AS policy_reference,
 CASE WHEN dept='Specialty Lines' THEN coalesce(area, own) ELSE 'group ' || p_type END AS "TrifocusName"
FROM cd JOIN cob ON code=p_type LEFT JOIN foc ON foc.p_brand=cd.p_brand AND dept='Specialty Lines'
WHERE dept IS NOT NULL AND (dept<>'Specialty Lines' OR p_size<>13)""")
def trifocus(t: Tables) -> DataFrame:
    reference = F.concat(F.col("p_partkey").cast("string"), F.lit("abcdefgh"))
    details = t.part.select(reference.alias("cpd_policy_reference"), F.lit("ab").alias("cpd_udt_initials"),
                            F.when(F.col("p_size") < 25, F.concat(F.lit("own"), "p_size")).alias("cpd_tri_focus"))
    policy = t.part.select(reference.alias("pol_cpd_policy_reference"), F.col("p_type").alias("pol_cob_code"),
                           F.lit("m").alias("pol_mop_code"), F.col("p_brand").alias("pol_stats_code"))
    # part size 13 has only a second risk class, so its specialty lines drop out
    risk = t.part.select(reference.alias("prc_cpd_policy_ref"), F.lit("rc").alias("prc_risk_class"),
                         F.when(F.col("p_size") == 13, 2).otherwise(1).alias("prc_sequence_no"))
    focus = t.part.filter(F.col("p_brand").like("Brand#1%")).select(
        F.lit("ECONOMY").alias("foc_cob_code"), F.lit("rc").alias("foc_risk_class"), F.lit("m").alias("foc_mop_code"),
        F.lit("ab").alias("foc_udt_initials"), F.col("p_brand").alias("foc_stats_code"),
        F.concat(F.lit("area "), "p_brand").alias("foc_area")).distinct()
    cob = t.part.select("p_type").distinct().select(
        F.col("p_type").alias("cob_code"),
        F.when(F.col("p_type") == "ECONOMY", "Specialty Lines").when(F.col("p_type") != "PROMO", "Other").alias("cob_dept"),
        F.concat(F.lit("group "), "p_type").alias("cob_tri_group"))
    return trifocus_code(details, policy, risk, focus, cob)


@query("trifocus_names", """
SELECT p_partkey, CASE WHEN p_type='PROMO' THEN 'UK Marine' WHEN p_type='LARGE' THEN CASE WHEN p_size<20 THEN 'BUSA Engineering'
 WHEN p_size<40 THEN 'BICI Engineering' ELSE p_name END WHEN p_type='SMALL' THEN 'target' ELSE p_name END AS focus FROM part""")
def trifocus_names(t: Tables) -> DataFrame:
    from portfolio_ops.functions import fixed_values as fv
    kind, size = F.col("p_type"), F.col("p_size")
    companies = [pattern.replace("%", " x ").strip() for pattern in fv.BUILDERS_RISK_FOCUS]
    product = (F.when(kind == "PROMO", fv.MARINE_PRODUCTS[0])
               .when(kind == "LARGE", fv.BUILDERS_RISK_PRODUCT.replace("%", " 2020")).otherwise("other"))
    company = F.when(size < 20, companies[0]).when(size < 40, companies[1])
    target = F.when(kind == "SMALL", "target")
    return t.part.select("p_partkey", trifocus_name(product, company, target, F.col("p_name")).alias("focus"))


# -- contracts and migration ------------------------------------------------

@query("contract_check", """
SELECT 'NOT NULL flag' AS rule, 'not_null' AS kind, count(*) FILTER (l_returnflag='N') AS violations FROM lineitem
UNION ALL SELECT 'LENGTH l_linestatus', 'length', 0
UNION ALL SELECT 'LINE_PK', 'unique', CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) FROM lineitem
UNION ALL SELECT 'LINE_ORDER_FK', 'foreign', count(*) FROM lineitem WHERE NOT EXISTS
 (SELECT 1 FROM orders WHERE o_orderkey=l_orderkey AND o_orderpriority<>'5-LOW')""")
def contracts(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    contract = Contract(not_null=("flag",), unique={"LINE_PK": ("l_orderkey", "l_linenumber")},
                        foreign={"LINE_ORDER_FK": ForeignKey(("l_orderkey",), "orders", ("o_orderkey",))},
                        max_length={"l_linestatus": 1})
    parents = {"orders": t.orders.filter(F.col("o_orderpriority") != "5-LOW")}
    return check_contract(rows, contract, parents)


@query("schema_migration", """
SELECT o_orderkey, o_custkey, o_orderstatus AS "STATUS_NME", o_orderpriority AS "PRIORITY_CDE", o_totalprice,
 CAST(7 AS DOUBLE) AS "PROCESS_ID", strftime(o_orderdate, '%Y-%m-%d') AS "EVENT_TIMESTAMP" FROM orders""")
def migration(t: Tables) -> DataFrame:
    step = TableMigration(columns={"o_orderstatus": "STATUS_NME", "o_orderpriority": "PRIORITY_CDE"},
                          add={"PROCESS_ID": "decimal(38,0)", "EVENT_TIMESTAMP": "timestamp"}, drop=("o_orderdate",))
    dated = t.orders.withColumn("_event", F.col("o_orderdate"))
    moved = migrate_table(dated, step, {"PROCESS_ID": F.lit(7), "EVENT_TIMESTAMP": F.col("_event")})
    return flat(moved.drop("_event"))
