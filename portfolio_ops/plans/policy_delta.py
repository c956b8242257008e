"""Incremental policy load with source rules and precedence deletes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.functions.exprs import (
    folded, is_true, map_literal, same_text, source_priority, text_in)
from portfolio_ops.operators.change import drop_superseded
from portfolio_ops.operators.dedupe import distinct_rows, distinct_text, first_per_key
from portfolio_ops.operators.filters import changed_since, delete_where, stored_state, touched_at, touched_since
from portfolio_ops.operators.lookups import lookup
from portfolio_ops.schemas import POLICY_ALL
from portfolio_ops.session import stage
from portfolio_ops.sources.snapshot import select_for


@dataclass(frozen=True)
class PolicyInputs:
    policy: DataFrame
    policy_ext: DataFrame
    section_ext: DataFrame
    placement_method: DataFrame
    dedupe: DataFrame


def placement_code(source: Column, admitted: Column, own: Column) -> Column:
    """Placement-method code: by admitted flag for the data contract, else the policy's own."""
    by_flag = (F.when(same_text(admitted, fv.ADMITTED_FLAG), F.lit(fv.ADMITTED_METHOD_CODE))
               .otherwise(F.lit(fv.OTHER_METHOD_CODE)))
    return F.when(same_text(source, fv.DATA_CONTRACT_SOURCE), by_flag).otherwise(own)


def policy_rules(p: str = "p", e: str = "e", s: str = "s") -> dict[str, Column]:
    """Columns that depend on the source system. ``_method`` is the looked-up name."""
    source = F.col(f"{p}.SourceSystem")
    contract = is_true(same_text(source, fv.DATA_CONTRACT_SOURCE))
    pro = is_true(same_text(source, fv.PRO_SOURCE))
    return {
        "IsAdmitted": F.when(contract, F.lit(fv.ADMITTED_LABEL)).otherwise(F.col(f"{p}.IsAdmitted")),
        "ErpExpirationDate": F.when(same_text(source, fv.ERP_FROM_SECTION_SOURCE),
                                    F.col(f"{s}.ErpExpirationDate"))
        .otherwise(F.col(f"{e}.ErpExpirationDate")),
        "MarketSegment": F.when(contract, map_literal(F.col(f"{p}.MarketSegment"), fv.MARKET_SEGMENTS,
                                                      ignore_case=True))
        .otherwise(F.col(f"{p}.MarketSegment")),
        "MethodOfPlacement": F.when(pro | contract, F.col("_method"))
        .otherwise(F.coalesce("_method", f"{e}.MethodOfPlacement")),
        "MethodOfPlacementCode": placement_code(source, F.col(f"{p}.IsAdmitted"),
                                                F.col(f"{e}.MethodOfPlacementCode")),
        "UPIFlag": F.when(pro, F.coalesce(f"{e}.UPIFlag", F.lit(0))).otherwise(F.lit(0)),
        "IsRenewal": F.when(pro, F.when(F.col(f"{p}.ExpiringPolicyReference").isNotNull(), 1))
        .when(contract, F.lit(None).cast("int")).otherwise(F.col(f"{p}.IsRenewal")),
        "PriorityDelete": source_priority(source),
        "TriaPercentage": F.when(pro, F.col(f"{e}.TriaPercentage")),
    }


def _known(df: DataFrame, reference: str, flag: str) -> DataFrame:
    """Distinct references of a list with a presence flag (join never multiplies rows)."""
    return (df.select(folded(reference).alias(f"_{flag}_ref")).distinct()
            .withColumn(flag, F.lit(True)))


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({"_s": folded("SourceSystem"), "_i": folded("PolicySourceId")})


def candidate_keys(policy: DataFrame, sides: Sequence[DataFrame], inputs: PolicyInputs, stored: DataFrame,
                   mark) -> DataFrame:
    """``_s, _i`` of every policy that a changed row, or a reference in neither list, may select.

    From scans of keys, times and references only; the time filter reaches the scan. A superset
    of what the full condition selects, as that also needs the rows to meet.
    """
    def changed(df: DataFrame) -> DataFrame:
        return df.filter(touched_since(mark, "AuditCreateDateTime", "AuditModifyDateTime")).select("_s", "_i")
    known = inputs.dedupe.select(folded("PolicyReference").alias("_ref")) \
        .unionByName(stored.select(folded("PolicyReference").alias("_ref"))).distinct()
    unknown = policy.select("_s", "_i", folded("PolicyReference").alias("_own")) \
        .join(known, F.col("_own") == F.col("_ref"), "left_anti").select("_s", "_i")
    found = reduce(lambda one, two: one.unionByName(two), [changed(df) for df in (policy, *sides)], unknown)
    return found.filter("_s is not null and _i is not null").distinct()


def changed_policies(inputs: PolicyInputs, stored: DataFrame, mark, first_load: bool = False) -> DataFrame:
    """Policies changed since the mark or in neither list, with the source rules applied.

    Candidate keys first: the wide rows of each side are reduced to them before they are
    joined. A first load takes every policy, so it goes without.
    """
    excluded = text_in(F.coalesce("OriginatingSourceSystem", F.lit(fv.MISSING_ORIGIN)),
                       fv.EXCLUDED_ORIGINS)
    sides = [_keyed(inputs.policy), _keyed(inputs.policy_ext.filter(~excluded)),
             _keyed(inputs.section_ext.filter(F.col("SectionSequenceId") == 1))]
    if not first_load:
        keys = stage(candidate_keys(sides[0], sides[1:], inputs, stored, mark), "candidates")
        sides = [df.join(keys, ["_s", "_i"], "left_semi") for df in sides]
    p, e, s = (df.alias(name) for df, name in zip(sides, "pes"))

    rows = (p.join(e, (F.col("p._s") == F.col("e._s")) & (F.col("p._i") == F.col("e._i")))
            .join(s, (F.col("p._s") == F.col("s._s")) & (F.col("p._i") == F.col("s._i")), "left"))
    reference = folded("p.PolicyReference")
    rows = rows.join(_known(stored, "PolicyReference", "stored"), reference == F.col("_stored_ref"), "left")
    rows = rows.join(_known(inputs.dedupe, "PolicyReference", "listed"),
                     reference == F.col("_listed_ref"), "left")
    changed = changed_since(mark, *[touched_at(f"{t}.AuditCreateDateTime", f"{t}.AuditModifyDateTime")
                                    for t in ("p", "e", "s")])
    rows = rows.filter(changed | (F.col("stored").isNull() & F.col("listed").isNull()))
    rows = lookup(rows, inputs.placement_method,
                  folded(placement_code(F.col("p.SourceSystem"), F.col("p.IsAdmitted"),
                                        F.col("e.MethodOfPlacementCode"))),
                  folded("Code"), {"_method": F.col("Name")})
    computed = policy_rules()

    def value(name: str) -> Column | str:
        if name in computed:
            return computed[name].alias(name)
        side = ("p" if name in fv.POLICY_OWN_COLUMNS
                else "s" if name in fv.POLICY_SECTION_COLUMNS else "e")
        return f"{side}.{name}"

    found = select_for(rows.select(*[value(n) for n in fv.POLICY_COLUMNS]), POLICY_ALL)
    # a first load is the whole table, so only digests are shuffled; a delta is small
    return (distinct_rows if first_load else distinct_text)(found, found.columns, folded)


def policy_delta(inputs: PolicyInputs, stored: DataFrame) -> DataFrame:
    """Rows that replace the delta table."""
    mark, first_load = stored_state(stored, "AuditCreateDateTime", "AuditModifyDateTime")
    rows = changed_policies(inputs, stored, mark, first_load)
    rows = delete_where(rows, same_text("OriginatingSourceSystem", fv.RETIRED_ORIGIN)
                        & (F.col("YearOfAccount") >= fv.RETIRED_ORIGIN_FROM_YEAR))
    if first_load:
        rows = one_per_reference(rows)
    # read twice below: as the rows to keep and as the list of newer sources
    rows = stage(rows, "policy")
    rows = drop_superseded(rows, rows, "PolicyReference", "SourceSystem",
                           fv.SUPERSEDED_SOURCES, fold=folded)
    return drop_superseded(rows, stored, "PolicyReference", "SourceSystem",
                           fv.SUPERSEDED_SOURCES, fold=folded)


def one_per_reference(rows: DataFrame) -> DataFrame:
    """First load: one source per reference by priority, ties by source and row id."""
    return first_per_key(rows, [folded("PolicyReference")], [
        F.col("PriorityDelete").asc_nulls_first(), F.col("SourceSystem").asc_nulls_first(),
        F.col("HashBytesId").asc_nulls_first()])
