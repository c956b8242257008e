import datetime as dt
from contextlib import contextmanager
from dataclasses import fields
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from portfolio_ops import schemas as s
from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.plans import claim_movement
from portfolio_ops.plans.claim_movement import (
    ClaimInputs, LEDGER_UPDATES, claim_movement_ledger, ledger_source, merge_ledger,
    movements_without_rate)
from portfolio_ops.session import stage

SOURCE = {"source_system": fv.CLAIM_SOURCE}


@contextmanager
def settings(spark, **wanted):
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def day(n):
    return dt.datetime(2024, 1, n)


def movement(exposure, number, kind, when, ref=None, ccy="USD", orig="USD", transfer="Migration", **more):
    return dict(SOURCE, claim_exposure_source_id=exposure, movement_reference_source_id=ref or f"{exposure}-{number}",
                sequence_number=number, settlement_currency=ccy, original_currency=orig, movement_type=kind,
                movement_date=when, source_system_event_date_time=when, is_active=1, transfer_status=transfer, **more)


MOVES = [
    # hand-worked ledger: opening, reserve, eroding payment, recovery
    movement("E1", 1, "Reserve", day(1), to_date_outstanding_indemnity_in_reserving_ccy=D(100)),
    movement("E1", 2, "Payment", day(2), to_date_paid_indemnity_in_reserving_ccy=D(30), does_not_erode_reserves=False,
             tax_amount_in_original_ccy=D(3)),
    movement("E1", 3, "Recovery", day(3), to_date_paid_indemnity_in_reserving_ccy=D(10)),
    # market scheme on one date: order YA, YC, YB; then a later non-scheme row
    movement("E2", 1, "SCM", day(5), "YB1", to_date_outstanding_indemnity_in_reserving_ccy=D(7),
             outstanding_original_ccy_to_settlement_ccy_rate=D(0)),
    movement("E2", 2, "SCM", day(5), "YC1", movement_reserve_indemnity_amount_in_original_ccy=D(5)),
    movement("E2", 3, "SCM", day(5), "YA1"),
    movement("E2", 4, "Reserve", day(1), to_date_outstanding_indemnity_in_reserving_ccy=D(50)),
    movement("E2", 5, "Payment", day(2), to_date_paid_indemnity_in_reserving_ccy=D(20), does_not_erode_reserves=True),
    # not completed, and a missing date
    movement("E3", 1, "Reserve", day(1), transfer="Draft", to_date_outstanding_fees_in_reserving_ccy=D(1)),
    movement("E3", 2, "Reserve", None, transfer="Transaction Complete", to_date_outstanding_fees_in_reserving_ccy=D(4)),
    # other currency: converted by the latest rate, or not when the group rate is zero
    movement("E4", 1, "Reserve", day(1), ccy="JPY", orig="JPY", original_ccy_to_group_ccy_rate=D(2),
             to_date_outstanding_indemnity_in_reserving_ccy=D(300)),
    movement("E4", 2, "Reserve", day(2), ccy="JPY", orig="JPY", original_ccy_to_group_ccy_rate=D(0),
             to_date_outstanding_indemnity_in_reserving_ccy=D(11)),
    # first ranked row inactive, another active: no opening row
    dict(movement("E5", 1, "Reserve", day(9), "z"), is_active=0),
    movement("E5", 1, "Reserve", day(1), "a", to_date_outstanding_indemnity_in_reserving_ccy=D(1)),
    # only an inactive row: opening row without a currency
    dict(movement("E6", 1, "Reserve", day(9), ccy="GBP"), is_active=0),
    movement("E8", 1, "Reserve", day(1)), movement("E9", 1, "Reserve", day(1)),
]
EXPOSURES = [dict(SOURCE, claim_exposure_source_id=e, claim_source_id=c, exposure_opened_date=day(1), signed=D("0.5"), is_active=1)
             for e, c in [("E1", "C"), ("E2", "C"), ("E3", "C"), ("E4", "C"), ("E5", "C"), ("E6", "C"), ("E7", "C"),
                          ("E8", "RETIRED"), ("E9", "INCIDENT")]]
CLAIMS = [dict(SOURCE, claim_source_id="C", is_active=1), dict(SOURCE, claim_source_id="RETIRED", is_active=1, is_retired=1),
          dict(SOURCE, claim_source_id="INCIDENT", is_active=1, incident_report=1)]
RATES = [dict(id=i, currency_code_name=c, rate_type_id=t, rate_to_usd=D(r), effective_from_date=d)
         for i, c, t, r, d in [(1, "JPY", 3, 100, day(1)), (2, "JPY", 3, 150, day(2)), (3, "JPY", 3, 3, day(2)),
                               (4, "JPY", 1, 7, day(9))]]


@pytest.fixture(scope="module")
def inputs(make):
    moves = s.MOVEMENT.fieldNames()
    ext = s.MOVEMENT_EXT.fieldNames()
    return ClaimInputs(
        make(s.MOVEMENT, [{k: v for k, v in m.items() if k in moves} for m in MOVES]),
        make(s.MOVEMENT_EXT, [dict({k: v for k, v in m.items() if k in ext}, is_active=1) for m in MOVES]),
        make(s.EXPOSURE, EXPOSURES),
        make(s.EXPOSURE_EXT, [dict(SOURCE, claim_exposure_source_id="E2", scm_reference="M", is_active=1),
                              dict(SOURCE, claim_exposure_source_id="E1", scm_reference="M", is_active=0)]),
        make(s.CLAIM, CLAIMS), make(s.EXCHANGE_RATE, RATES))


@pytest.fixture(scope="module")
def ledger(inputs):
    return claim_movement_ledger(inputs).cache()


def rows(df, exposure, *names):
    out = df.filter(F.col("exposure_reference") == exposure).orderBy("movement_group_sequence_id")
    return [tuple(r) for r in out.select(*names).collect()]


def test_hand_worked_balances(ledger):
    got = rows(ledger, "E1", "movement_group_sequence_id", "movement_type", "movement_paid_indemnity_in_settlement_ccy",
               "to_date_outstanding_indemnity_in_settlement_ccy", "sequence_number_order_id")
    assert got == [(1, "N/A", 0, 0, 4), (2, "Reserve", 0, 100, 3), (3, "Payment", 30, 70, 2), (4, "Recovery", -10, 70, 1)]
    assert rows(ledger, "E1", "movement_tax_amount_in_original_ccy")[2] == (3,)


def test_scheme_rows_first_and_in_switch_order(ledger):
    got = rows(ledger, "E2", "movement_reference", "movement_type", "to_date_outstanding_indemnity_in_settlement_ccy",
               "to_date_outstanding_indemnity_in_original_ccy", "does_not_erode_reserves")
    assert got == [("YA1", "SCM", 0, 0, True), ("YC1", "SCM", 0, 5, True), ("YB1", "SCM", 7, 0, True),
                   ("E2-4", "Reserve", 50, 50, False), ("E2-5", "Payment", 50, 50, True)]
    assert rows(ledger, "E2", "outstanding_original_ccy_to_settlement_ccy_rate")[2] == (1,)


def test_incomplete_and_undated(ledger):
    got = rows(ledger, "E3", "sequence_number", "movement_date", "to_date_outstanding_fees_in_original_ccy")
    # the draft is left out; a missing date is filled after ordering
    assert got == [(0, day(1), 0), (1, dt.datetime(1753, 1, 1), 4)]


def test_conversion(ledger):
    got = rows(ledger, "E4", "settlement_currency", "settlement_source_currency", "original_currency",
               "movement_outstanding_indemnity_in_settlement_ccy", "movement_outstanding_indemnity_in_source_settlement_ccy")
    # latest date, then highest id: 1/3 at six decimals; zero group rate converts at 1
    assert got == [("USD", "JPY", "JPY", 0, 0), ("USD", "JPY", "JPY", D("99.9999"), 300), ("USD", "JPY", "JPY", 11, 11)]


def test_opening_rows(ledger):
    assert [r[0] for r in rows(ledger, "E5", "movement_type")] == ["Reserve"]
    assert rows(ledger, "E6", "movement_reference", "settlement_currency", "settlement_source_currency", "signed_line") == [
        (fv.DUMMY_REFERENCE, "USD", None, D("0.5"))]
    assert len(rows(ledger, "E7", "movement_type")) == 1
    assert rows(ledger, "E8", "movement_type") == [] == rows(ledger, "E9", "movement_type")


def test_group_numbers(ledger):
    groups = {tuple(r) for r in ledger.select("exposure_reference", "movement_group_id").collect()}
    assert groups == {(f"E{i}", i) for i in range(1, 8)}


def test_column_order_and_types(ledger):
    assert [(f.name, f.dataType) for f in ledger.schema.fields] == [(f.name, f.dataType) for f in s.LEDGER.fields]
    assert len(s.LEDGER.fields) == 54


def test_segmented_way_gives_the_same_ledger(inputs, ledger):
    cut = claim_movement_ledger(inputs, group_rows=3)
    as_set = lambda df: sorted(map(repr, df.collect()))
    assert as_set(cut) == as_set(ledger)


@pytest.mark.parametrize("parts", [1, 37])
def test_independent_of_partitioning(spark, inputs, ledger, parts):
    spread = ClaimInputs(**{f.name: getattr(inputs, f.name).repartition(parts) for f in fields(ClaimInputs)})
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert sorted(map(repr, claim_movement_ledger(spread).collect())) == sorted(map(repr, ledger.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_missing_rate(make, inputs):
    bad = movement("E7", 1, "Reserve", day(1), ccy="XXX", original_ccy_to_group_ccy_rate=D(2))
    names, ext = s.MOVEMENT.fieldNames(), s.MOVEMENT_EXT.fieldNames()
    with_bad = ClaimInputs(
        inputs.movement.union(make(s.MOVEMENT, [{k: v for k, v in bad.items() if k in names}])),
        inputs.movement_ext.union(make(s.MOVEMENT_EXT, [dict({k: v for k, v in bad.items() if k in ext}, is_active=1)])),
        inputs.exposure, inputs.exposure_ext, inputs.claim, inputs.exchange_rate)
    with pytest.raises(Exception, match="exchange rate of the settlement currency"):
        claim_movement_ledger(with_bad)
    left = claim_movement_ledger(with_bad, missing_rate="quarantine")
    assert rows(left, "E7", "movement_type") == []  # the whole exposure is held back
    others = claim_movement_ledger(inputs).filter("exposure_reference <> 'E7'")
    group = [c for c in left.columns if c != "movement_group_id"]
    assert sorted(map(repr, left.select(group).collect())) == sorted(map(repr, others.select(group).collect()))
    assert [r["settlement_currency"] for r in movements_without_rate(with_bad).collect()] == ["XXX"]


def test_merge(spark, make, ledger):
    run = lambda name: make(s.LATEST_RUN, [{"id": name}])
    empty = spark.createDataFrame([], s.LEDGER_TABLE)
    first = merge_ledger(empty, ledger, run("r1")).cache()
    assert first.count() == ledger.count()
    again = merge_ledger(first, ledger, run("r2"))
    assert {r[0] for r in again.select("process_id").distinct().collect()} == {"r1"}  # unchanged hashes
    changed = ledger.filter("exposure_reference <> 'E7'").withColumn(
        "payment_type", F.when(F.col("exposure_reference") == "E1", "P").otherwise(F.col("payment_type"))).withColumn(
        "settlement_source_currency", F.when(F.col("exposure_reference") == "E1", "NEW")
        .otherwise(F.col("settlement_source_currency")))
    last = merge_ledger(first, changed, run("r3"))
    assert last.filter("exposure_reference = 'E7'").count() == 0
    assert {r[0] for r in last.filter("process_id = 'r3'").select("exposure_reference").collect()} == {"E1"}
    # covered by the hash but set on insert only
    assert last.filter("settlement_source_currency = 'NEW'").count() == 0
    assert last.filter("payment_type = 'P'").count() == 4
    source = ledger_source(ledger, run("r1"))
    assert len(source.first()["row_hash_key"]) == 32
    assert "settlement_source_currency" not in LEDGER_UPDATES and "created_by" not in LEDGER_UPDATES


def test_no_wide_rows_are_written_or_moved_for_group_numbers(spark, inputs, monkeypatch):
    widths = {}
    monkeypatch.setattr(claim_movement, "stage", lambda df, label="stage": (
        widths.update({label: len(df.columns)}), stage(df, label))[1])
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plan = claim_movement_ledger(inputs)._jdf.queryExecution().executedPlan().toString()
    assert max(widths.values()) <= 5
    union = next(i for i, line in enumerate(plan.splitlines()) if line.lstrip(" :").startswith("+- Union"))
    assert "Exchange" not in "\n".join(plan.splitlines()[:union])


def test_join_near_is_the_join(spark):
    schema = "k string, n int, {0} string, {1} decimal(19,4)"
    left = spark.createDataFrame([("a", 1, "x", D(1)), ("a", 1, "y", None), ("a", 2, "z", D(2)), (None, 1, "u", D(3)),
                                  ("b", None, "v", D(4)), ("c", 1, None, None)], schema.format("l", "p"))
    right = spark.createDataFrame([("a", 1, "1", D(1)), ("a", 1, None, None), ("b", None, "3", D(4)), (None, 1, "4", None),
                                   ("c", 1, "5", D(6)), ("d", 1, "6", D(7))], schema.format("r", "q"))
    got, want = claim_movement.join_near(left, right, ["k", "n"]), left.join(right, ["k", "n"])
    assert got.columns == want.columns and want.count() == 5
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_merge_takes_a_ledger_with_hashes_as_it_is(spark, make, ledger, monkeypatch):
    run = make(s.LATEST_RUN, [{"id": "r1"}])
    source = stage(ledger_source(ledger, run))
    monkeypatch.setattr(claim_movement, "ledger_source", None)
    merged = merge_ledger(spark.createDataFrame([], s.LEDGER_TABLE), source, run)
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, source.select(merged.columns).collect()))
