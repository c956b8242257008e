"""The claim-movement job on movements derived from lineitem, orders and customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.analogues.registry import Tables, conform, flat, money, query
from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.plans.claim_movement import (
    ClaimInputs, claim_movement_ledger, ledger_source, merge_ledger)
from portfolio_ops.schemas import (
    CLAIM, EXCHANGE_RATE, EXPOSURE, EXPOSURE_EXT, LEDGER, MOVEMENT, MOVEMENT_EXT, OUTSTANDING,
    PAID, PARTS, SIDE_AMOUNTS, TO_DATE, amounts)
from portfolio_ops.session import stage


def claim_inputs(t: Tables) -> ClaimInputs:
    lines = (t.lineitem.groupBy("l_orderkey", "l_linestatus", "l_linenumber", "l_returnflag")
             .agg(F.sum(money("l_extendedprice")).alias("_indemnity"),
                  F.sum(money("l_quantity")).alias("_fees"), F.sum(money("l_tax")).alias("_defence"),
                  F.min("l_shipdate").alias("_shipped")))
    # the job reads movements as a stored table, so the derived one is stored too
    lines = stage(lines, "movements")
    number, flag, status = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus")
    prefix = F.when(number.isin(1, 4, 7), "YA").when(number.isin(2, 5), "YB").otherwise("YC")
    reserve = flag == "N"
    measures = {}
    for part in PARTS:
        value = F.col(f"_{part}")
        measures |= {f"movement_reserve_{part}_amount_in_original_ccy": value,
                     f"movement_paid_{part}_in_original_ccy": value + 1,
                     f"to_date_paid_{part}_in_reserving_ccy": F.when(~reserve, value),
                     f"to_date_outstanding_{part}_in_reserving_ccy": F.when(reserve, value + 2)}
    keyed = lines.withColumns({
        "source_system": F.lit(fv.CLAIM_SOURCE),
        "claim_exposure_source_id": F.col("l_orderkey").cast("string"),
        "movement_reference_source_id": F.concat(prefix, F.lit("-"), status, flag,
                                                 number.cast("string")),
        "sequence_number": number,
        "settlement_currency": F.when(flag == "R", "EUR").when(status == "F", "USD").otherwise("JPY"),
        "original_currency": F.when(status == "F", "GBP").otherwise("CHF"),
    })
    movement = keyed.withColumns({
        "movement_type": F.when(flag == "A", fv.PAYMENT_TYPE).when(flag == "R", fv.RECOVERY_TYPE)
        .when(status == "F", fv.MIGRATED_TYPE).otherwise("Reserve"),
        "movement_period": F.when(number.isin(2, 4), F.date_trunc("MONTH", "_shipped")),
        "movement_date": F.when(number != 7, F.col("_shipped")),
        "original_ccy_to_group_ccy_rate": F.when(number == 5, 0.0).otherwise(1.5),
        "outstanding_original_ccy_to_settlement_ccy_rate": F.when(number == 4, 0.0).otherwise(1.25),
        **measures,
        "net_payment_amount_in_original_ccy": F.col("_indemnity"),
        "net_payment_amount_in_settlement_ccy": F.col("_fees"),
        "tax_amount_in_original_ccy": F.col("_defence"),
        "does_not_erode_reserves": F.when(number != 1, number == 3),
        "source_system_event_date_time": F.col("_shipped"),
        "is_active": F.when(number == 6, 0).otherwise(1),
    })
    ext = keyed.withColumns({
        "transaction_created_on": F.when(number == 2, F.col("_shipped")),
        "payment_id": F.when(flag == "A", F.concat(F.lit("pay"), number.cast("string"))),
        "transfer_status": F.when(number.isin(3, 6), "Migration").when(number == 2, "Pending")
        .when(number != 5, "Transaction Complete"),
        "is_active": F.lit(1),
    })
    order_id = F.col("o_orderkey").cast("string").alias("claim_exposure_source_id")
    system = F.lit(fv.CLAIM_SOURCE).alias("source_system")
    exposure = t.orders.select(
        order_id, system, F.col("o_custkey").cast("string").alias("claim_source_id"),
        F.col("o_orderdate").alias("exposure_opened_date"), F.lit(0.5).alias("signed"),
        F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(1).alias("is_active"))
    # '' is no reference, a blank is one
    reference = F.when(F.col("o_orderpriority") == "1-URGENT", "M1").when(
        F.col("o_orderpriority") == "2-HIGH", " ").otherwise("")
    exposure_ext = t.orders.filter(F.col("o_orderpriority") < "4").select(
        order_id, system, reference.alias("scm_reference"), F.lit(1).alias("is_active"))
    claim = t.customer.select(
        F.col("c_custkey").cast("string").alias("claim_source_id"), system,
        F.lit(1).alias("is_active"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 1).alias("incident_report"),
        F.lit(None).alias("is_retired"))
    rate = t.nation.select(
        F.col("n_nationkey").alias("id"),
        F.when(F.col("n_regionkey") == 0, "GBP").otherwise("JPY").alias("currency_code_name"),
        F.when(F.col("n_nationkey") < 20, fv.RATE_TYPE_ID).otherwise(1).alias("rate_type_id"),
        (F.col("n_nationkey") + 100).alias("rate_to_usd"),
        F.timestamp_add("DAY", F.col("n_regionkey"), F.lit("2020-01-01").cast("timestamp"))
        .alias("effective_from_date"))
    return ClaimInputs(conform(movement, MOVEMENT), conform(ext, MOVEMENT_EXT),
                       conform(exposure, EXPOSURE), conform(exposure_ext, EXPOSURE_EXT),
                       conform(claim, CLAIM), conform(rate, EXCHANGE_RATE))


def _each(template: str) -> str:
    return ",\n ".join(template.format(p=p) for p in PARTS)


_CCYS = [("original", "original"), ("settlement", "settlement"), ("source_settlement", "source_settlement")]
_SQL = f"""
WITH lines AS (
 SELECT l_orderkey, l_linestatus AS st, l_linenumber AS n, l_returnflag AS fl,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(19,4))) AS DECIMAL(19,4)) AS indemnity,
  CAST(sum(CAST(l_quantity AS DECIMAL(19,4))) AS DECIMAL(19,4)) AS fees,
  CAST(sum(CAST(l_tax AS DECIMAL(19,4))) AS DECIMAL(19,4)) AS defence, min(l_shipdate) AS shipped
 FROM lineitem GROUP BY ALL),
mv AS (
 SELECT *, CAST(l_orderkey AS VARCHAR) AS exposure,
  CASE WHEN n IN (1,4,7) THEN 'YA' WHEN n IN (2,5) THEN 'YB' ELSE 'YC' END || '-' || st || fl || n AS ref,
  CASE WHEN fl='R' THEN 'EUR' WHEN st='F' THEN 'USD' ELSE 'JPY' END AS ccy,
  CASE WHEN st='F' THEN 'GBP' ELSE 'CHF' END AS orig,
  CASE WHEN fl='A' THEN 'Payment' WHEN fl='R' THEN 'Recovery' WHEN st='F' THEN 'SCM' ELSE 'Reserve' END AS type,
  CASE WHEN n IN (2,4) THEN date_trunc('month', shipped)::TIMESTAMP END AS period,
  CASE WHEN n<>7 THEN shipped END AS mdate,
  CASE WHEN n=5 THEN 0 ELSE 1.5 END AS group_rate,
  CASE WHEN n=4 THEN 0 ELSE 1.25 END AS out_rate,
  CASE WHEN n<>1 THEN n=3 END AS no_erode,
  CASE WHEN n IN (3,6) THEN 'Migration' WHEN n=2 THEN 'Pending' WHEN n<>5 THEN 'Transaction Complete' END AS transfer,
  CASE WHEN fl='N' THEN NULL ELSE indemnity END AS paid_indemnity,
  CASE WHEN fl='N' THEN NULL ELSE fees END AS paid_fees,
  CASE WHEN fl='N' THEN NULL ELSE defence END AS paid_defence,
  CASE WHEN fl='N' THEN indemnity+2 END AS open_indemnity,
  CASE WHEN fl='N' THEN fees+2 END AS open_fees,
  CASE WHEN fl='N' THEN defence+2 END AS open_defence
 FROM lines),
exposures AS (
 SELECT CAST(o_orderkey AS VARCHAR) AS exposure, o_orderdate AS opened,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'M1' WHEN '2-HIGH' THEN ' ' END AS scm_ref
 FROM orders JOIN customer ON c_custkey=o_custkey
 WHERE o_orderpriority<>'5-LOW' AND c_mktsegment<>'MACHINERY'),
rates AS (
 SELECT CASE WHEN n_regionkey=0 THEN 'GBP' ELSE 'JPY' END AS code,
  CAST(1.0::DOUBLE/(n_nationkey+100) AS DECIMAL(19,6)) AS ratio
 FROM nation WHERE n_nationkey<20
 QUALIFY row_number() OVER (PARTITION BY code ORDER BY n_regionkey DESC, n_nationkey DESC)=1),
real AS (
 SELECT e.exposure AS exposure_reference,
  row_number() OVER (PARTITION BY m.exposure ORDER BY coalesce(period, mdate) NULLS LAST, mdate NULLS LAST,
    n NULLS LAST, ref NULLS LAST, ccy NULLS LAST, orig NULLS LAST) AS sequence_number,
  CASE WHEN scm_ref IS NULL THEN type ELSE ref END AS movement_reference,
  CASE WHEN ccy IN ('EUR','USD','CAD','GBP') THEN ccy ELSE 'USD' END AS settlement_currency,
  ccy AS settlement_source_currency,
  CASE WHEN type='SCM' THEN orig ELSE ccy END AS original_currency,
  CASE WHEN ccy IN ('EUR','USD','CAD','GBP') OR group_rate=0 THEN 1 ELSE ratio END AS usd_rate,
  CASE WHEN type='SCM' THEN out_rate ELSE 1 END AS orate, 1 AS prate, mdate AS movement_date,
  {_each("CASE WHEN type='SCM' THEN {p} ELSE 0 END AS {TO_DATE}_{p}_in_original_ccy".replace("{TO_DATE}", TO_DATE))},
  {_each("CASE WHEN type='SCM' THEN coalesce(open_{p},0) ELSE 0 END AS to_date_outstanding_{p}_in_source_settlement_ccy")},
  {_each("CASE WHEN type='SCM' THEN {p}+1 ELSE coalesce(paid_{p},0) END AS movement_paid_{p}_in_original_ccy")},
  {_each("coalesce(paid_{p},0) AS movement_paid_{p}_in_source_settlement_ccy")},
  {_each("coalesce(open_{p},0) AS movement_outstanding_{p}_in_original_ccy")},
  {_each("coalesce(open_{p},0) AS movement_outstanding_{p}_in_source_settlement_ccy")},
  {_each("coalesce(open_{p},0) AS {p}_reserve_in_settlement_ccy")},
  type AS movement_type, CASE WHEN type='SCM' THEN true ELSE coalesce(no_erode,false) END AS does_not_erode_reserves,
  CASE WHEN fl='A' THEN 'pay'||n END AS payment_id, NULL::DOUBLE AS signed_line, transfer AS transfer_status,
  indemnity AS net_o, fees AS net_s, defence AS tax_o, 0 AS tax_s,
  CASE WHEN n=2 THEN shipped ELSE mdate END AS movement_creation_date
 FROM mv m JOIN exposures e ON e.exposure=m.exposure LEFT JOIN rates ON code=ccy
 WHERE n<>6 AND (type='SCM' OR coalesce(transfer,'') IN ('Migration','Transaction Complete'))),
ranked AS (
 SELECT *, row_number() OVER (PARTITION BY exposure ORDER BY shipped DESC NULLS FIRST, n, ref, ccy, orig) AS rn
 FROM mv WHERE n=1),
dummy AS (
 SELECT e.exposure, 0, 'DUMMY MOVEMENT', CASE WHEN ccy IN ('EUR','USD','CAD','GBP') THEN ccy ELSE 'USD' END,
  ccy, coalesce(orig,'USD'), 1, 1, 1, opened, {", ".join(["0"] * 18)}, NULL, NULL, NULL,
  'N/A', true, NULL, 0.5, NULL, 0, 0, 0, 0, opened
 FROM exposures e LEFT JOIN ranked r ON r.exposure=e.exposure
 WHERE scm_ref IS NULL AND coalesce(rn,1)=1 AND (mdate IS NULL OR type<>'SCM')),
t AS (SELECT * FROM real UNION ALL SELECT * FROM dummy),
staged AS (
 SELECT *, dense_rank() OVER (ORDER BY exposure_reference NULLS LAST, settlement_currency NULLS LAST) AS movement_group_id,
  row_number() OVER (PARTITION BY exposure_reference, settlement_currency ORDER BY
   CASE WHEN movement_type='SCM' THEN movement_date END NULLS LAST,
   CASE WHEN movement_type='SCM' AND movement_reference LIKE 'YA%' THEN 1
        WHEN movement_type='SCM' AND movement_reference LIKE 'YC%' THEN 2
        WHEN movement_type='SCM' AND movement_reference LIKE 'YB%' THEN 3 END NULLS LAST,
   sequence_number NULLS LAST, movement_reference NULLS LAST, original_currency NULLS LAST) AS movement_group_sequence_id
 FROM t),
conv AS (
 SELECT * REPLACE (
  {", ".join(f"CASE WHEN movement_type='Recovery' THEN -movement_paid_{p}_in_{c}_ccy ELSE movement_paid_{p}_in_{c}_ccy END AS movement_paid_{p}_in_{c}_ccy" for p in PARTS for c in ("original", "source_settlement"))},
  {", ".join(f"CASE WHEN movement_type='Recovery' THEN -{c} ELSE {c} END AS {c}" for c in ("net_o", "net_s", "tax_o", "tax_s"))}),
  {", ".join(f"CAST(CAST({s}_{p}_in_source_settlement_ccy AS DECIMAL(19,4))*CAST(usd_rate AS DECIMAL(19,6)) AS DECIMAL(19,4)) AS raw_{s}_{p}" for s in (TO_DATE, PAID, OUTSTANDING) for p in PARTS)}
 FROM staged),
signed AS (
 SELECT *, {", ".join(f"raw_{s}_{p} AS {s}_{p}_in_settlement_ccy" for s in (TO_DATE, OUTSTANDING) for p in PARTS)},
  {", ".join(f"CASE WHEN movement_type='Recovery' THEN -raw_{PAID}_{p} ELSE raw_{PAID}_{p} END AS {PAID}_{p}_in_settlement_ccy" for p in PARTS)}
 FROM conv),
flows AS (
 SELECT exposure_reference, movement_group_id, movement_group_sequence_id,
  {", ".join(f"lag({TO_DATE}_{p}_in_{c}_ccy,1,0) OVER w + {OUTSTANDING}_{p}_in_{c}_ccy - CASE WHEN movement_type='Payment' AND NOT does_not_erode_reserves THEN {PAID}_{p}_in_{c}_ccy ELSE 0 END AS f_{p}_{c}" for p in PARTS for c, _ in _CCYS)}
 FROM signed WHERE movement_type<>'SCM'
 WINDOW w AS (PARTITION BY exposure_reference, movement_group_id ORDER BY movement_group_sequence_id)),
balances AS (
 SELECT exposure_reference, movement_group_id, movement_group_sequence_id,
  {", ".join(f"sum(f_{p}_{c}) OVER (PARTITION BY exposure_reference, movement_group_id ORDER BY movement_group_sequence_id ROWS UNBOUNDED PRECEDING) AS b_{p}_{c}" for p in PARTS for c, _ in _CCYS)}
 FROM flows)
SELECT s.exposure_reference, CAST(sequence_number AS BIGINT) AS sequence_number, movement_reference,
 settlement_currency, settlement_source_currency, original_currency,
 CAST(s.movement_group_id AS BIGINT) AS movement_group_id,
 CAST(s.movement_group_sequence_id AS BIGINT) AS movement_group_sequence_id,
 CAST(max(s.movement_group_sequence_id) OVER (PARTITION BY s.movement_group_id) + 1 - s.movement_group_sequence_id AS BIGINT) AS sequence_number_order_id,
 CAST(CASE WHEN orate=0 THEN 1 ELSE orate END AS DOUBLE) AS outstanding_original_ccy_to_settlement_ccy_rate,
 CAST(prate AS DOUBLE) AS paid_original_ccy_to_settlement_ccy_rate,
 strftime(coalesce(movement_date, TIMESTAMP '1753-01-01'), '%Y-%m-%d') AS movement_date,
 {", ".join(f"CAST(CASE WHEN movement_type='SCM' THEN {TO_DATE}_{p}_in_{c}_ccy ELSE b_{p}_{c} END AS DOUBLE) AS {TO_DATE}_{p}_in_{c}_ccy" for p in PARTS for c, _ in _CCYS)},
 {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in amounts(PAID))},
 movement_type,
 {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in amounts(OUTSTANDING))},
 CAST(does_not_erode_reserves AS BIGINT) AS does_not_erode_reserves,
 {", ".join(f"CAST({p}_reserve_in_settlement_ccy AS DOUBLE) AS {p}_reserve_in_settlement_ccy" for p in PARTS)},
 payment_id, CAST(NULL AS VARCHAR) AS payment_type, CAST(signed_line AS DOUBLE) AS signed_line,
 CAST(NULL AS VARCHAR) AS transaction_tracking_status, transfer_status,
 {", ".join(f"CAST({c} AS DOUBLE) AS {n}" for c, n in zip(("net_o", "net_s", "tax_o", "tax_s"), SIDE_AMOUNTS))},
 strftime(movement_creation_date, '%Y-%m-%d') AS movement_creation_date
FROM signed s LEFT JOIN balances b ON b.movement_group_id=s.movement_group_id
 AND b.movement_group_sequence_id=s.movement_group_sequence_id
"""


@query("claim_movement_ledger", _SQL)
def ledger(t: Tables) -> DataFrame:
    return flat(claim_movement_ledger(claim_inputs(t)).select(*LEDGER.fieldNames()))


@query("claim_movement_ledger_segmented", _SQL)
def ledger_segmented(t: Tables) -> DataFrame:
    """Exposures of more than five movements are cut into segments."""
    return flat(claim_movement_ledger(claim_inputs(t), group_rows=5).select(*LEDGER.fieldNames()))


@query("ledger_merge", f"""
WITH l AS ({_SQL}), d AS (SELECT *, right(exposure_reference, 1) AS digit FROM l)
SELECT exposure_reference, sequence_number, movement_reference, settlement_currency,
 CASE WHEN digit='2' THEN 'old' ELSE settlement_source_currency END AS settlement_source_currency,
 CASE WHEN digit='3' THEN 'old' ELSE payment_type END AS payment_type,
 CASE WHEN digit IN ('1','2') THEN 'r2' ELSE 'r1' END AS process_id
FROM d""")
def ledger_merge(t: Tables) -> DataFrame:
    """Today's ledger merged into a stored one. By the last digit of the exposure: 1 is new, 2
    has changed (the unconverted currency is set on insert only), 3 has changed but no stored
    hash, 4 also has a stored exposure that has vanished; the others are unchanged."""
    def run(name: str) -> DataFrame:
        return t.spark.createDataFrame([(name,)], "id string")
    source = stage(ledger_source(claim_movement_ledger(claim_inputs(t)), run("r2")), "today")
    today = source.select(*LEDGER.fieldNames())
    digit = F.right("exposure_reference", F.lit(1))
    old = F.lit("old")
    before = today.filter(digit != "1").withColumns({
        "payment_type": F.when(digit.isin("2", "3"), old).otherwise(F.col("payment_type")),
        "settlement_source_currency": F.when(digit == "2", old).otherwise(F.col("settlement_source_currency"))})
    gone = today.filter(digit == "4").withColumn(
        "exposure_reference", F.concat(F.lit("X"), "exposure_reference"))
    # the merge reads the stored table more than once, so the derived one is stored too
    stored = stage(ledger_source(before.unionByName(gone), run("r1")).withColumn(
        "row_hash_key", F.when(digit != "3", F.col("row_hash_key"))), "stored")
    merged = merge_ledger(stored, source, run("r2"))
    return merged.select("exposure_reference", "sequence_number", "movement_reference", "settlement_currency",
                         "settlement_source_currency", "payment_type", "process_id")
