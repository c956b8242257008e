"""Jobs run against their target tables."""
import datetime as dt
from dataclasses import replace
from decimal import Decimal as D

import pytest

from portfolio_ops import schemas as s
from portfolio_ops.operators.contract import ContractViolation
from portfolio_ops.plans import publish, vault_model as vm
from portfolio_ops.plans.homeowners import homeowners_load
from portfolio_ops.sources.snapshot import SnapshotTable, nullable

from test_claim_movement import inputs, movement  # noqa: F401  (inputs is a fixture)
from test_homeowners import BINDERS, FEED


def test_ledger(spark, make, tmp_path, inputs):  # noqa: F811
    table = SnapshotTable(spark, str(tmp_path / "ledger"), nullable(s.LEDGER_TABLE))
    run = make(s.LATEST_RUN, [{"id": "r1"}])
    first = publish.publish_ledger(table, inputs, run)
    assert first.rows_inserted == table.read().count() > 0
    second = publish.publish_ledger(table, inputs, make(s.LATEST_RUN, [{"id": "r2"}]))
    assert (second.version, second.rows_inserted) == (2, first.rows_inserted)
    assert [r[0] for r in table.read().select("process_id").distinct().collect()] == ["r1"]


def test_homeowners(spark, make, tmp_path):
    feed, binders = make(s.FEED, FEED), make(s.SECTION_SOURCE, BINDERS)
    made = homeowners_load(feed, binders)
    targets = {n: SnapshotTable(spark, str(tmp_path / n), nullable(getattr(made, n).schema))
               for n in ("policy", "section", "transaction")}
    results = publish.publish_homeowners(targets, feed, binders)
    assert [r.rows_inserted for r in results] == [2, 3, 3]


def test_small_jobs(spark, make, tmp_path):
    ratio = SnapshotTable(spark, str(tmp_path / "ratio"), s.struct(("AgressoReference", s.TEXT), ("CessionMultiplier", s.RATE)))
    marine = make(s.MARINE_PREMIUM, [dict(Reference="r", Period2=1, GrossWrittenPremium=D(4), CededPremiumToInternalFAC=D(1))])
    publish.publish_cession(ratio, make(s.PREMIUM, []), marine, make(s.WEATHER_PREMIUM, []))
    assert [tuple(r) for r in ratio.read().collect()] == [("r", D("0.25"))]
    facts = SnapshotTable(spark, str(tmp_path / "facts"), s.KEY_INDUSTRY)
    doc = '{"Result":{"Key_Industry":{"Code_Str":"1"}}}'
    interim = make(s.RATING_INTERIM, [dict(BK_RATER_NAME="r", BK_VERSION="1", BK_RATING_ID="i", BK_CLIENT_SUPPLIED_ID="c",
                                           RECORD_CONTENT=doc)])
    assert [publish.publish_key_industry(facts, interim).rows_inserted for _ in range(2)] == [1, 0]


def test_vault_contract_stops_an_orphan(spark, make, tmp_path):
    targets = {n: SnapshotTable(spark, str(tmp_path / n), nullable(vm.schema(n))) for n in vm.TABLES}
    tech = dict(RECORD_SOURCE_NAME="f", SOURCE_SYSTEM_NAME="crm", LOAD_DATETIME=dt.datetime(2024, 1, 1))
    hub = make(nullable(vm.schema("HUB_POLICY")), [dict(tech, POLICY_REFERENCE_NK="p")])
    publish.publish_vault(targets, {"HUB_POLICY": hub})
    key = targets["HUB_POLICY"].read().first()["HUB_POLICY_HK"]
    sat = "SAT_POLICY_DETAIL_RAW"

    def row(hk):
        return make(nullable(vm.schema(sat)), [dict(tech, HUB_POLICY_HK=hk, PROCESS_ID=D(1))])
    assert publish.publish_vault(targets, {sat: row(key)})[0].version == 1
    with pytest.raises(ContractViolation, match="HUB_POLICY_FK: 1"):
        publish.publish_vault(targets, {sat: row("0" * 32)})
    assert targets[sat].version() == 1


def test_quarantine_keeps_the_stored_rows(spark, make, tmp_path, inputs):  # noqa: F811
    """An exposure without a rate is held back whole; its stored rows stay, the others load."""
    table = SnapshotTable(spark, str(tmp_path / "ledger"), nullable(s.LEDGER_TABLE))
    aside = SnapshotTable(spark, str(tmp_path / "aside"), nullable(inputs.movement.drop("is_active").schema))
    publish.publish_ledger(table, inputs, make(s.LATEST_RUN, [{"id": "r1"}]))
    before = table.read().drop("created_at_ts")
    bad = movement("E1", 99, "Reserve", dt.datetime(2024, 1, 1), ccy="XXX", original_ccy_to_group_ccy_rate=D(2))
    names, ext = s.MOVEMENT.fieldNames(), s.MOVEMENT_EXT.fieldNames()
    with_bad = replace(
        inputs, movement=inputs.movement.union(make(s.MOVEMENT, [{k: v for k, v in bad.items() if k in names}])),
        movement_ext=inputs.movement_ext.union(
            make(s.MOVEMENT_EXT, [dict({k: v for k, v in bad.items() if k in ext}, is_active=1)])))
    with pytest.raises(Exception, match="exchange rate of the settlement currency"):
        publish.publish_ledger(table, with_bad, make(s.LATEST_RUN, [{"id": "r2"}]))
    publish.publish_ledger(table, with_bad, make(s.LATEST_RUN, [{"id": "r2"}]), quarantine=aside)
    held = "exposure_reference = 'E1'"
    after = table.read().drop("created_at_ts")
    assert before.filter(held).count() > 0
    same = [c for c in before.columns if c != "movement_group_id"]
    assert sorted(map(repr, after.select(same).filter(held).collect())) \
        == sorted(map(repr, before.select(same).filter(held).collect()))
    plain = [c for c in same if c not in ("process_id", "row_hash_key", "created_by", "created_from", "source_name")]
    assert sorted(map(repr, after.select(plain).collect())) == sorted(map(repr, before.select(plain).collect()))
    assert [r["settlement_currency"] for r in aside.read().collect()] == ["XXX"]


def test_vault_late_rows_are_published_beside_the_satellite(spark, make, tmp_path):
    sat = "SAT_POLICY_DETAIL_RAW"
    schemas = {n: vm.schema(n) for n in vm.TABLES} | {vm.late_name(sat): vm.late_schema(sat)}
    targets = {n: SnapshotTable(spark, str(tmp_path / n), nullable(schema), str(tmp_path / "log"))
               for n, schema in schemas.items()}
    tech = dict(RECORD_SOURCE_NAME="f", SOURCE_SYSTEM_NAME="crm")
    hub = make(nullable(vm.schema("HUB_POLICY")), [dict(tech, POLICY_REFERENCE_NK="p", LOAD_DATETIME=dt.datetime(2024, 1, 1))])
    publish.publish_vault(targets, {"HUB_POLICY": hub})
    key = targets["HUB_POLICY"].read().first()["HUB_POLICY_HK"]

    def batch(*versions):
        return make(nullable(vm.schema(sat)), [
            dict(tech, HUB_POLICY_HK=key, PROCESS_ID=D(1), POLICY_STATUS_NAME=v,
                 LOAD_DATETIME=dt.datetime(2024, 1, d) if d else None) for d, v in versions])
    publish.publish_vault(targets, {sat: batch((3, "b"))})
    again = batch((2, "a"), (None, "n"), (3, "b"), (4, "c"))
    assert [r.rows_inserted for r in publish.publish_vault(targets, {sat: again})] == [2, 2]
    assert [r.rows_inserted for r in publish.publish_vault(targets, {sat: again})] == [2, 0]
    late = targets[vm.late_name(sat)].read().collect()
    assert sorted(r["POLICY_STATUS_NAME"] for r in late) == ["a", "n"]
    bare = {n: t for n, t in targets.items() if n != vm.late_name(sat)}
    with pytest.raises(ContractViolation, match="late rows: 2"):
        publish.publish_vault(bare, {sat: again})
