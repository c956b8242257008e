"""Smaller whole jobs on tables derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.analogues.registry import Tables, conform, double, flat, money, query
from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.plans.cession import cession_multiplier
from portfolio_ops.plans.claim_binder import claim_binder_pairs
from portfolio_ops.plans.key_industry import key_industry
from portfolio_ops.plans.mapping_override import land_mapping_override, live_overrides
from portfolio_ops.schemas import (
    CLAIM_EXPOSURE, CLAIM_HEADER, KEY_INDUSTRY, MARINE_PREMIUM, PREMIUM, RATING_INTERIM,
    WEATHER_PREMIUM)
from portfolio_ops.sources.landing import land_events


# -- cession ----------------------------------------------------------------

def premium_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    lines = t.lineitem.withColumns({
        # one reference in two spellings, and with a trailing blank
        "Reference": F.concat(F.when(F.col("l_linenumber") == 2, "ab").otherwise("AB"), "l_suppkey",
                              F.when(F.col("l_linenumber") == 3, " ").otherwise("")),
        "Period2": F.year("l_shipdate") * 100 + F.month("l_shipdate"),
        "_price": money("l_extendedprice"), "_qty": money("l_quantity"), "_tax": money("l_tax"),
        "_disc": F.nullif(money("l_discount"), F.lit(0).cast("decimal(19,4)"))})
    first = lines.filter(F.col("l_returnflag") == "A").withColumns({
        "GPW": -F.col("_price"), "ICWP_F": F.col("_qty"), "ICWP_Q": F.col("_disc"),
        "ICWP_S": F.lit(None), "ICWP_EMBQ": F.col("_tax")})
    second = lines.filter(F.col("l_returnflag") == "N").withColumns({
        "GrossWrittenPremium": F.col("_price"),
        "CededPremiumToInternalQuotaShareTreaty": F.col("_disc"),
        "CededPremiumToInternalFAC": F.col("_qty")})
    third = lines.filter(F.col("l_returnflag") == "R").withColumns({
        "GrossWrittenPremium": F.col("_price"),
        "CededPremiumToInternalQuotaShareTreaty": F.col("_tax"),
        "CededPremiumToInternalSurplusTreaty": F.col("_disc")})
    return (conform(first, PREMIUM), conform(second, MARINE_PREMIUM), conform(third, WEATHER_PREMIUM))


def _ratio_sql(flag: str, premium: str, cession: str) -> str:
    return f"""
SELECT spelling AS "AgressoReference", round(CAST(c AS DOUBLE) / CAST(p AS DOUBLE), 6) AS "CessionMultiplier"
FROM (SELECT min(ref) AS spelling, sum({premium}) AS p, sum({cession}) AS c FROM l
      WHERE l_returnflag='{flag}' AND period=(SELECT max(period) FROM l WHERE l_returnflag='{flag}')
      GROUP BY lower(rtrim(ref, ' '))) WHERE p<>0 AND c<>0"""


@query("cession_multiplier", f"""
WITH l AS (SELECT *, CASE WHEN l_linenumber=2 THEN 'ab' ELSE 'AB' END || l_suppkey || CASE WHEN l_linenumber=3 THEN ' ' ELSE '' END AS ref, year(l_shipdate)*100+month(l_shipdate) AS period,
 CAST(l_extendedprice AS DECIMAL(19,4)) AS price, CAST(l_quantity AS DECIMAL(19,4)) AS qty,
 CAST(l_tax AS DECIMAL(19,4)) AS tax, nullif(CAST(l_discount AS DECIMAL(19,4)), 0) AS disc FROM lineitem)
{_ratio_sql("A", "price", "qty+coalesce(disc,0)+tax")} UNION ALL
{_ratio_sql("N", "price", "coalesce(disc,0)+qty")} UNION ALL
{_ratio_sql("R", "price", "tax+coalesce(disc,0)")}""")
def cession(t: Tables) -> DataFrame:
    out = cession_multiplier(*premium_tables(t))
    return out.select("AgressoReference",
                      F.round(double("CessionMultiplier"), 6).alias("CessionMultiplier"))


# -- claim / binder pairs ---------------------------------------------------

@query("claim_binder_pairs", """
SELECT DISTINCT 'C' || o_custkey AS "PolicyNumber", 'B' || l_suppkey AS "BinderReference"
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE l_returnflag <> 'N' AND l_linestatus = 'F' AND o_orderstatus <> 'P'""")
def claim_binder(t: Tables) -> DataFrame:
    exposures = conform(t.lineitem.select(
        F.when(F.col("l_linestatus") == "F", "ClaimCenter").otherwise("Other").alias("SourceSystem"),
        F.col("l_orderkey").alias("ClaimSourceId"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("B"), "l_suppkey"))
        .alias("BinderReference")), CLAIM_EXPOSURE)
    claims = conform(t.orders.select(
        F.lit("CLAIMCENTER").alias("SourceSystem"), F.col("o_orderkey").alias("ClaimSourceId"),
        F.concat(F.lit("C"), "o_custkey").alias("PolicyNumber"),
        F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "O", 0)
        .alias("IsRetired")), CLAIM_HEADER)
    return claim_binder_pairs(exposures, claims)


# -- rating facts -----------------------------------------------------------

def rating_interim(events: DataFrame) -> DataFrame:
    """Events as landed topic records whose JSON carries the industry code."""
    code = F.when(F.col("event_type") != "error", F.concat(F.lit('"'), F.get_json_object("props", "$.k"), F.lit('"')))
    content = F.concat(F.lit('{"Result":{"Key_Industry":{"Code_Name":null,"Code_Str":'),
                       F.coalesce(code, F.lit("null")), F.lit(',"Code_Type":"NAICS"}}}'))
    records = events.select(
        F.col("event_type").alias("BK_RATER_NAME"), F.col("user_id").alias("BK_VERSION"),
        F.col("event_id").alias("BK_RATING_ID"), F.lit("c").alias("BK_CLIENT_SUPPLIED_ID"),
        content.alias("value"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("offset"), F.lit(0).alias("partition"))
    return conform(land_events(records, keep=fv.KEY_INDUSTRY_KEYS), RATING_INTERIM)


def stored_key_industry(t: Tables) -> DataFrame:
    early = t.events.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    return conform(rating_interim(early), KEY_INDUSTRY)


@query("key_industry_json", """
SELECT event_type AS "BK_RATER_NAME", CAST(user_id AS VARCHAR) AS "BK_VERSION",
 CAST(event_id AS VARCHAR) AS "BK_RATING_ID", json_extract_string(props, '$.k') AS "KEY_INDUSTRY_KEY",
 CAST(NULL AS VARCHAR) AS "CODE_NAME", 'NAICS' AS "CODE_TYPE", event_id AS "RECORD_KAFKA_OFFSET"
FROM events WHERE event_type <> 'error' AND json_extract_string(props, '$.k') IS NOT NULL
 AND ts >= TIMESTAMP '2024-01-10'""")
def key_industry_json(t: Tables) -> DataFrame:
    rows = key_industry(rating_interim(t.events), stored_key_industry(t))
    return rows.select("BK_RATER_NAME", "BK_VERSION", "BK_RATING_ID", "KEY_INDUSTRY_KEY",
                       "CODE_NAME", "CODE_TYPE", "RECORD_KAFKA_OFFSET")


# -- section-mapping override -----------------------------------------------

OVERRIDE_DEFAULTS = {"CREATED_BY": "loader", "CREATED_FROM": "event feed", "SOURCE_NAME": "overrides"}


@query("mapping_override", """
SELECT CAST(event_id AS DOUBLE) AS "ID", 'E' || user_id AS "CCV9_EXPOSURE_REFERENCE",
 'S' || event_type AS "NEW_SECTION_REFERENCE",
 CASE WHEN event_type='click' THEN 'web' ELSE 'loader' END AS "CREATED_BY",
 'event feed' AS "CREATED_FROM",
 'overrides' AS "SOURCE_NAME"
FROM events WHERE event_type <> 'error'""")
def mapping_override(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    records = t.events.select(
        F.col("event_id").alias("ID"), F.concat(F.lit("E"), "user_id").alias("CCV9_EXPOSURE_REFERENCE"),
        F.concat(F.lit("S"), kind).alias("NEW_SECTION_REFERENCE"),
        F.when(kind == "click", "web").alias("CREATED_BY"),
        F.when(kind == "error", True).when(kind == "view", False).alias("IS_DELETED"))
    rows = live_overrides(land_mapping_override(_with_absent(records), OVERRIDE_DEFAULTS))
    return flat(rows.select("ID", "CCV9_EXPOSURE_REFERENCE", "NEW_SECTION_REFERENCE", "CREATED_BY",
                            "CREATED_FROM", "SOURCE_NAME"))


def _with_absent(records: DataFrame) -> DataFrame:
    """Columns the topic never carries arrive as NULL."""
    from portfolio_ops.schemas import MAPPING_OVERRIDE
    filled = [f for f in MAPPING_OVERRIDE.fields
              if f.name not in ("CREATED_AT", "CREATED_FROM", "SOURCE_NAME")]
    return records.select(*[
        (F.col(f.name) if f.name in records.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in filled])
