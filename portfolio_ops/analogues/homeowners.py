"""The homeowners job on a text feed derived from lineitem, orders and customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.analogues.registry import Tables, conform, flat, money, query
from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.plans.homeowners import binder_mapping, homeowners_load
from portfolio_ops.schemas import FEED, SECTION_SOURCE

YEARS_LATER = 14
STATES = {"AUTOMOBILE": "NY", "BUILDING": "tx", "FURNITURE": "DC", "MACHINERY": "CA"}
STATUSES = {1: "BOUND", 2: "QUOTED", 3: "Cancelled", 4: "MTA QUOTE", 5: "NEW"}


def _case(col, mapping):
    chain = None
    for code, text in mapping.items():
        chain = F.when(col == code, text) if chain is None else chain.when(col == code, text)
    return chain


def feed(t: Tables) -> DataFrame:
    # the few rows first, so that lines are shuffled once
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    number, priority = F.col("l_linenumber"), F.col("o_orderpriority")
    key = F.concat(F.lit("K"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    begin = F.make_date(F.year("o_orderdate") + YEARS_LATER, F.month("o_orderdate"), F.lit(15))
    return conform(rows.select(
        F.when(number != 6, key).alias("PK_Policy"), key.alias("FK_Policy"),
        F.when((number != 6) | (F.col("l_returnflag") != "N"), F.concat_ws(
            "-", F.lit("S"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0"),
            number.cast("string"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"),
            F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))).alias("PK_Section"),
        F.when(priority == "1-URGENT", F.concat(F.lit("C"), "o_custkey")).otherwise(
            F.concat(F.lit("R"), "o_orderkey")).alias("PolicyReference"),
        number.alias("SectionSequenceID"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("IsQuote"),
        F.when(number == 3, F.concat(F.lit("X"), "o_custkey")).alias("ExpiringPolicyReference"),
        F.date_format(begin, "yyyy-MM-dd").alias("InceptionDate"),
        F.when(number != 4, "cover").otherwise("").alias("CoverageName"),
        F.when(F.col("l_returnflag") == "N", fv.EXCLUDED_TRIFOCUS)
        .when(F.col("l_returnflag") == "A", "Focus").alias("TriFocus"),
        _case(number, STATUSES).alias("SectionStatus"),
        F.when(F.col("l_linestatus") == "F", fv.FLOOD_PRODUCT)
        .when(priority == "2-HIGH", fv.WIND_PRODUCT).when(priority != "5-LOW", "Home").alias("ProductName"),
        F.lit("old").alias("FacilityReference"),
        _case(F.col("c_mktsegment"), STATES).alias("_state"),
        F.when(number == 1, _case(F.col("c_mktsegment"), STATES)).alias("InsuredState"),
        F.when(number == 2, "").otherwise("writer").alias("UnderwriterName"),
        F.when(priority == "3-MEDIUM", "EUR").alias("PolLimitCurrency"),
        F.lit("USD").alias("OriginalCurrency"),
        F.col("o_custkey").cast("string").alias("BrokerBeazleyTradeId"),
        F.year(begin).cast("string").alias("YearOfAccount"),
        money("o_totalprice").cast("string").alias("PolicyLimit"),
        F.when(number == 1, "n/a").otherwise("12.5").alias("PolicyDeductible"),
        money("l_extendedprice").cast("string").alias("WrittenOrEstimatedPremium"),
        (money("l_discount") * 100).cast("decimal(19,4)").cast("string")
        .alias("ExternalAcquisitionCostPercentage")), FEED)


def section_source(t: Tables) -> DataFrame:
    """Binder sections per year; class letter and code from the region and nation."""
    region, nation = F.col("n_regionkey"), F.col("n_nationkey")
    letter = F.when(nation < 9, "A").when(nation < 18, "B").otherwise("C")
    code = F.when(region < 3, "YH").otherwise("3Y")
    return conform(t.nation.select(
        (region + 2012).alias("FK_YOA"),
        F.concat(F.when(nation == 5, "Z").otherwise("B6188C"), nation.cast("string"), letter, F.lit("x"), code)
        .alias("SectionReference"), code.alias("SectionReferenceCOBCode")), SECTION_SOURCE)


def _sql_case(col: str, mapping: dict) -> str:
    return "CASE " + col + "".join(f" WHEN {k!r} THEN '{v}'" for k, v in mapping.items()) + " END"


_FEED = f"""
WITH raw AS (
 SELECT *, 'K' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS fk,
  CASE WHEN l_linenumber<>6 THEN 'K' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') END AS pk,
  CASE WHEN l_linenumber<>6 OR l_returnflag<>'N' THEN 'S-' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || '-' || l_linenumber
   || '-' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') END AS sk,
  CASE WHEN o_orderpriority='1-URGENT' THEN 'C' || o_custkey ELSE 'R' || o_orderkey END AS ref,
  make_date(year(o_orderdate)+{YEARS_LATER}, month(o_orderdate), 15) AS begin,
  CASE WHEN l_linestatus='F' THEN 'Excess Flood' WHEN o_orderpriority='2-HIGH' THEN 'Excess Wind & Hail'
   WHEN o_orderpriority<>'5-LOW' THEN 'Home' END AS product,
  CASE l_returnflag WHEN 'N' THEN 'BESI Homeowners' WHEN 'A' THEN 'Focus' END AS focus,
  {_sql_case("c_mktsegment", STATES)} AS state
 FROM lineitem JOIN orders ON o_orderkey=l_orderkey JOIN customer ON c_custkey=o_custkey),
kept AS (SELECT * FROM raw WHERE NOT (pk IS NULL AND sk IS NULL) AND NOT (l_linenumber=4 AND focus IS NULL)),
feed AS (SELECT * FROM kept QUALIFY pk IS NULL OR pk = max(pk) OVER (PARTITION BY ref)),
latest AS (SELECT fk, l_linenumber, max(sk) AS sk, sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS premium FROM feed GROUP BY 1, 2),
expiring AS (SELECT pk, max(CASE WHEN l_linenumber=3 THEN 'X' || o_custkey END) AS x FROM feed GROUP BY 1),
policy AS (
 SELECT f.pk, f.ref, x, state, c_mktsegment, o_totalprice, o_orderpriority, o_custkey, year(begin) AS yoa
 FROM feed f JOIN latest l ON l.sk=f.sk AND l.l_linenumber=1 JOIN expiring e ON e.pk=f.pk
 WHERE o_orderstatus<>'P' AND year(begin)>=2010)
"""
_SECTIONS = _FEED + f""",
nat AS (SELECT n_regionkey+2012 AS yoa, CASE WHEN n_nationkey=5 THEN 'Z' ELSE 'B6188C' END || n_nationkey ||
  CASE WHEN n_nationkey<9 THEN 'A' WHEN n_nationkey<18 THEN 'B' ELSE 'C' END || 'x' ||
  CASE WHEN n_regionkey<3 THEN 'YH' ELSE '3Y' END AS r, CASE WHEN n_nationkey<9 THEN 'A' WHEN n_nationkey<18 THEN 'B' ELSE 'C' END AS letter
 FROM nation WHERE n_nationkey<>5),
binders AS (SELECT yoa, max(r) FILTER (letter='A') AS a, max(r) FILTER (letter='B') AS b, max(r) FILTER (letter='C') AS c FROM nat GROUP BY 1),
sec AS (
 SELECT f.sk, p.ref, l_seq, p.x, f.product, f.focus, p.yoa, l.premium, f.l_linenumber,
  CASE WHEN f.l_linenumber=1 THEN CAST(p.o_totalprice AS DECIMAL(19,4)) END AS lim,
  CASE WHEN f.l_linenumber=1 THEN CASE WHEN p.o_orderpriority='3-MEDIUM' THEN 'EUR' ELSE 'USD' END END AS lim_ccy,
  CASE WHEN f.l_linenumber=1 THEN f.state END AS state,
  CAST(CAST(f.l_discount AS DECIMAL(19,4))*100 AS DECIMAL(19,4)) AS pct, CAST(f.l_extendedprice AS DECIMAL(19,4)) AS own, f.begin
 FROM feed f JOIN policy p ON p.pk=f.fk
 JOIN (SELECT fk, l_linenumber AS l_seq, sk, premium FROM latest) l ON l.fk=f.fk AND l.l_seq=f.l_linenumber AND l.sk=f.sk),
named AS (SELECT *, CASE upper(state) WHEN 'NY' THEN 'New York' WHEN 'TX' THEN 'Texas' WHEN 'CA' THEN 'California' ELSE state END AS loc FROM sec),
final AS (
 SELECT n.*, n.ref || '-' || lpad(CAST(n.l_linenumber AS VARCHAR), 2, '0') AS section_ref,
  CASE WHEN product='Excess Flood' THEN coalesce(b, 'old')
   WHEN product='Excess Wind & Hail' AND n.yoa<2018 THEN coalesce(a, c, 'old')
   WHEN product='Excess Wind & Hail' THEN coalesce(c, 'old')
   WHEN product IS NOT NULL AND focus<>'BESI Homeowners' THEN coalesce(a, 'old') ELSE 'old' END AS facility,
  max(lim) FILTER (l_linenumber=1) OVER (PARTITION BY ref) AS first_lim,
  max(lim_ccy) FILTER (l_linenumber=1) OVER (PARTITION BY ref) AS first_ccy,
  max(loc) OVER (PARTITION BY ref) AS best_loc
 FROM named n LEFT JOIN binders ON binders.yoa=n.yoa)
"""


@query("homeowners_policy", _FEED + """
SELECT pk AS "PK_Policy", ref AS "PolicyReference", x AS "ExpiringPolicyReference",
 CASE WHEN state IS NULL THEN NULL ELSE state END AS "InsuredState", 'USA' AS "InsuredCountry",
 CAST(CAST(o_totalprice AS DECIMAL(19,4)) AS DOUBLE) AS "PolicyLimit", CAST(0 AS DOUBLE) AS "PolicyDeductible",
 CASE WHEN o_orderpriority='3-MEDIUM' THEN 'EUR' ELSE 'USD' END AS "LimitCurrency",
 CAST(yoa AS VARCHAR) AS "YearOfAccount", CAST(o_custkey AS VARCHAR) AS "BrokerBeazleyTradeId"
FROM policy""")
def policy(t: Tables) -> DataFrame:
    made = homeowners_load(feed(t), section_source(t)).policy
    return flat(made.select("PK_Policy", "PolicyReference", "ExpiringPolicyReference", "InsuredState",
                            "InsuredCountry", "PolicyLimit", "PolicyDeductible", "LimitCurrency",
                            "YearOfAccount", "BrokerBeazleyTradeId"))


@query("homeowners_section", _SECTIONS + """
SELECT sk AS "PK_Section", ref AS "PolicyReference", section_ref AS "SectionReference",
 CAST(l_linenumber AS BIGINT) AS "SectionSequenceID",
 CASE l_linenumber WHEN 1 THEN 'Live' WHEN 2 THEN 'Quote' WHEN 3 THEN 'Cancelled' WHEN 4 THEN 'Live' END AS "SectionStatus",
 x || '-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS "ExpiringSectionReference", facility AS "FacilityReference",
 product AS "ProductName", CAST(x IS NOT NULL AS BIGINT) AS "IsRenewal", best_loc AS "RiskLocation",
 CASE WHEN l_linenumber=2 THEN 'N/A' ELSE 'writer' END AS "UnderwriterName",
 CAST(premium AS DOUBLE) AS "WrittenOrEstimatedPremium", CAST(coalesce(lim, first_lim) AS DOUBLE) AS "SectionLimit",
 CASE WHEN lim IS NULL AND first_lim IS NOT NULL THEN first_ccy ELSE lim_ccy END AS "LimitCurrency",
 CASE WHEN l_linenumber=1 THEN 0::DOUBLE END AS "DeductibleAmount",
 round(CAST(pct AS DOUBLE) * CAST(own AS DOUBLE) / 100, 4) AS "ExternalAcquisitionCostAmount",
 CAST(yoa AS BIGINT) AS "YearOfAccount" FROM final""")
def section(t: Tables) -> DataFrame:
    made = flat(homeowners_load(feed(t), section_source(t)).section.select(
        "PK_Section", "PolicyReference", "SectionReference", "SectionSequenceID", "SectionStatus",
        "ExpiringSectionReference", "FacilityReference", "ProductName", "IsRenewal", "RiskLocation",
        "UnderwriterName", "WrittenOrEstimatedPremium", "SectionLimit", "LimitCurrency",
        "DeductibleAmount", "ExternalAcquisitionCostAmount", "YearOfAccount"))
    return made.withColumn("ExternalAcquisitionCostAmount", F.round("ExternalAcquisitionCostAmount", 4))


@query("homeowners_transaction", _SECTIONS + """
SELECT section_ref AS "FK_Section", strftime(date_trunc('month', begin), '%Y-%m-%d') AS "AccountingPeriod",
 strftime(begin, '%Y-%m-%d') AS "DateTimeCreated", 'AAP' AS "TransactionClass", CAST(premium AS DOUBLE) AS "ReceivedPremium",
 CAST(pct AS DOUBLE) AS "ExternalAcquisitionCostPercentage",
 round(CAST(premium AS DOUBLE) * CAST(pct AS DOUBLE) / 100, 4) AS "ExternalAcquisitionCostAmount",
 'USD' AS "OriginalCurrency", CAST(0 AS BIGINT) AS "TaxPayable" FROM final""")
def transaction(t: Tables) -> DataFrame:
    made = flat(homeowners_load(feed(t), section_source(t)).transaction.select(
        "FK_Section", "AccountingPeriod", "DateTimeCreated", "TransactionClass", "ReceivedPremium",
        "ExternalAcquisitionCostPercentage", "ExternalAcquisitionCostAmount", "OriginalCurrency",
        "TaxPayable"))
    return made.withColumn("ExternalAcquisitionCostAmount", F.round("ExternalAcquisitionCostAmount", 4))


@query("binder_mapping", """
SELECT CAST(n_regionkey+2012 AS BIGINT) AS "YOA", 'B6188C' || n_nationkey ||
 CASE WHEN n_nationkey<9 THEN 'A' WHEN n_nationkey<18 THEN 'B' ELSE 'C' END || 'x' ||
 CASE WHEN n_regionkey<3 THEN 'YH' ELSE '3Y' END AS "BinderReference" FROM nation WHERE n_nationkey<>5""")
def binders(t: Tables) -> DataFrame:
    return flat(binder_mapping(section_source(t)))
