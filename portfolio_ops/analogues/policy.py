"""The incremental policy load on policies derived from orders, customer and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.analogues.registry import Tables, conform, flat, query
from portfolio_ops.plans.policy_delta import PolicyInputs, policy_delta
from portfolio_ops.schemas import (
    DEDUPE_LIST, PLACEMENT_METHOD, POLICY, POLICY_EXT, SECTION_EXT, STORED_POLICY)

# source system by order priority, in mixed spelling
SOURCES = {"1-URGENT": "BeazleyPro", "2-HIGH": "fdr", "3-MEDIUM": "StagingDataContract",
           "4-NOT SPECIFIED": "UNIRISX", "5-LOW": "Gamechanger"}
STORED_BEFORE = "1998-06-01"
YEARS_LATER = 18


def _source():
    chain = None
    for priority, name in SOURCES.items():
        test = F.col("o_orderpriority") == priority
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain


def _modified():
    return F.when(F.col("o_orderstatus") == "P",
                  F.timestamp_add("DAY", F.lit(10), F.col("o_orderdate")).cast("timestamp_ntz"))


def policy_inputs(t: Tables) -> PolicyInputs:
    reference = F.concat(F.lit("P"), F.col("o_custkey"))
    status = F.col("o_orderstatus")
    policy = t.orders.select(
        F.col("o_orderkey").alias("PolicySourceId"), _source().alias("SourceSystem"),
        reference.alias("PolicyReference"),
        F.when(status == "F", "1").otherwise("0").alias("IsAdmitted"),
        F.when(status == "F", "PE").when(status == "O", "MM").otherwise("XX").alias("MarketSegment"),
        F.when(status == "O", "prior").alias("ExpiringPolicyReference"),
        F.when(status == "F", 1).otherwise(0).alias("IsRenewal"),
        (F.year("o_orderdate") + YEARS_LATER).alias("YearOfAccount"),
        F.col("o_orderkey").alias("HashBytesId"),
        F.col("o_orderdate").alias("AuditCreateDateTime"), _modified().alias("AuditModifyDateTime"))
    segment = F.col("c_mktsegment")
    ext = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.upper(_source()).alias("SourceSystem"), F.col("o_orderkey").alias("PolicySourceId"),
        F.when(segment == "BUILDING", "FDR").when(segment == "AUTOMOBILE", "EazyPro")
        .alias("OriginatingSourceSystem"),
        F.when(status == "F", "v").when(status == "O", "W").otherwise("X").alias("MethodOfPlacementCode"),
        F.lit("own").alias("MethodOfPlacement"),
        F.when(status == "F", 1).alias("UPIFlag"), F.lit(0.25).alias("TriaPercentage"),
        F.col("o_orderdate").alias("ErpExpirationDate"), F.col("c_name").alias("CRMBrokerName"),
        F.col("o_orderdate").alias("AuditCreateDateTime"))
    section = (t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_shipdate").alias("_end"),
                                                                   F.min("l_shipdate").alias("_start"))
               .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
               .select(_source().alias("SourceSystem"), F.col("o_orderkey").alias("PolicySourceId"),
                       F.col("l_linenumber").alias("SectionSequenceId"),
                       F.col("_end").alias("ErpExpirationDate"),
                       F.col("_start").alias("AuditCreateDateTime")))
    method = t.region.filter(F.col("r_regionkey") < 2).select(
        F.when(F.col("r_regionkey") == 0, "V").otherwise("w").alias("Code"), F.col("r_name").alias("Name"))
    dedupe = t.customer.filter(F.col("c_acctbal") < 1000).select(
        F.concat(F.lit("p"), F.col("c_custkey")).alias("PolicyReference"))
    return PolicyInputs(conform(policy, POLICY), conform(ext, POLICY_EXT), conform(section, SECTION_EXT),
                        conform(method, PLACEMENT_METHOD), conform(dedupe, DEDUPE_LIST))


def stored_policies(t: Tables) -> DataFrame:
    old = t.orders.filter((F.col("o_orderdate") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))
                          & (F.col("o_orderstatus") == "F"))
    return conform(old.select(
        F.concat(F.lit("P"), F.col("o_custkey")).alias("PolicyReference"),
        _source().alias("SourceSystem"), F.col("o_orderdate").alias("AuditCreateDateTime")), STORED_POLICY)


SHOWN = ["PolicyReference", "SourceSystem", "IsAdmitted", "MarketSegment", "MethodOfPlacement",
         "MethodOfPlacementCode", "UPIFlag", "IsRenewal", "PriorityDelete", "TriaPercentage",
         "OriginatingSourceSystem", "ErpExpirationDate", "YearOfAccount", "HashBytesId", "CRMBrokerName"]

_CASE = " ".join(f"WHEN '{p}' THEN '{s}'" for p, s in SOURCES.items())


def _sql(stored_filter: str, first_load: bool) -> str:
    dedupe = ("QUALIFY row_number() OVER (PARTITION BY \"PolicyReference\" ORDER BY \"PriorityDelete\", "
              "\"SourceSystem\", \"HashBytesId\") = 1" if first_load else "")
    return f"""
WITH o AS (SELECT *, CASE o_orderpriority {_CASE} END AS src, 'P' || o_custkey AS ref FROM orders),
stored AS (SELECT ref, src, o_orderdate AS seen FROM o WHERE {stored_filter}),
mark AS (SELECT coalesce(max(seen), TIMESTAMP '1900-01-01') AS m FROM stored),
sec AS (SELECT l_orderkey, max(l_shipdate) AS fin, min(l_shipdate) AS beg FROM lineitem WHERE l_linenumber=1 GROUP BY 1),
listed AS (SELECT 'P' || c_custkey AS ref FROM customer WHERE c_acctbal < 1000),
method AS (SELECT CASE r_regionkey WHEN 0 THEN 'V' ELSE 'W' END AS code, r_name FROM region WHERE r_regionkey < 2),
base AS (
 SELECT *, CASE WHEN src='StagingDataContract' THEN CASE WHEN o_orderstatus='F' THEN 'V' ELSE 'W' END
   ELSE CASE o_orderstatus WHEN 'F' THEN 'v' WHEN 'O' THEN 'W' ELSE 'X' END END AS code
 FROM o JOIN customer ON c_custkey=o_custkey LEFT JOIN sec ON l_orderkey=o_orderkey
 WHERE c_mktsegment<>'BUILDING'
  AND NOT (c_mktsegment='AUTOMOBILE' AND year(o_orderdate)+{YEARS_LATER}>=2017)
  AND (CASE WHEN o_orderstatus='P' THEN o_orderdate + INTERVAL 10 DAY ELSE o_orderdate END >= (SELECT m FROM mark)
    OR o_orderdate >= (SELECT m FROM mark) OR coalesce(beg >= (SELECT m FROM mark), false)
    OR (ref NOT IN (SELECT ref FROM stored) AND ref NOT IN (SELECT ref FROM listed)))),
shaped AS (
 SELECT ref AS "PolicyReference", src AS "SourceSystem",
  CASE WHEN src='StagingDataContract' THEN 'Lloyds' WHEN o_orderstatus='F' THEN '1' ELSE '0' END AS "IsAdmitted",
  CASE WHEN src='StagingDataContract' THEN CASE o_orderstatus WHEN 'F' THEN 'Private Enterprise' WHEN 'O' THEN 'Mid-Market' END
   ELSE CASE o_orderstatus WHEN 'F' THEN 'PE' WHEN 'O' THEN 'MM' ELSE 'XX' END END AS "MarketSegment",
  CASE WHEN src IN ('BeazleyPro','StagingDataContract') THEN r_name ELSE coalesce(r_name, 'own') END AS "MethodOfPlacement",
  base.code AS "MethodOfPlacementCode",
  CAST(CASE WHEN src='BeazleyPro' AND o_orderstatus='F' THEN 1 ELSE 0 END AS BIGINT) AS "UPIFlag",
  CAST(CASE WHEN src='BeazleyPro' THEN CASE WHEN o_orderstatus='O' THEN 1 END WHEN src='StagingDataContract' THEN NULL
   WHEN o_orderstatus='F' THEN 1 ELSE 0 END AS BIGINT) AS "IsRenewal",
  CAST(CASE WHEN src IN ('BeazleyPro','UNIRISX','Gamechanger') THEN 1 WHEN src='fdr' THEN 2 ELSE 3 END AS BIGINT) AS "PriorityDelete",
  CASE WHEN src='BeazleyPro' THEN 0.25::DOUBLE END AS "TriaPercentage",
  CASE WHEN c_mktsegment='AUTOMOBILE' THEN 'EazyPro' END AS "OriginatingSourceSystem",
  strftime(CASE WHEN src='Gamechanger' THEN fin ELSE o_orderdate END, '%Y-%m-%d') AS "ErpExpirationDate",
  CAST(year(o_orderdate)+{YEARS_LATER} AS BIGINT) AS "YearOfAccount", CAST(o_orderkey AS VARCHAR) AS "HashBytesId",
  c_name AS "CRMBrokerName"
 FROM base LEFT JOIN method ON method.code=upper(base.code)),
deduped AS (SELECT * FROM shaped {dedupe}),
every AS (SELECT "PolicyReference" AS r, "SourceSystem" AS s FROM deduped UNION ALL SELECT ref, src FROM stored)
SELECT * FROM deduped d
WHERE NOT ("SourceSystem"='fdr' AND EXISTS (SELECT 1 FROM every WHERE r=d."PolicyReference" AND s='BeazleyPro'))
 AND NOT ("SourceSystem"='StagingDataContract' AND EXISTS (SELECT 1 FROM every WHERE r=d."PolicyReference" AND s='UNIRISX'))
"""


@query("policy_delta", _sql(f"o_orderdate < TIMESTAMP '{STORED_BEFORE}' AND o_orderstatus='F'", False))
def delta(t: Tables) -> DataFrame:
    return flat(policy_delta(policy_inputs(t), stored_policies(t)).select(*SHOWN))


@query("policy_first_load", _sql("false", True))
def first_load(t: Tables) -> DataFrame:
    return flat(policy_delta(policy_inputs(t), stored_policies(t).filter(F.lit(False))).select(*SHOWN))
