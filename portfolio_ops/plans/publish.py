"""Jobs with their targets: compute, check, publish, report the rows written."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from portfolio_ops.operators.contract import Contract, ContractViolation
from portfolio_ops.plans import vault_model
from portfolio_ops.plans.cession import cession_multiplier
from portfolio_ops.plans.claim_binder import claim_binder_pairs
from portfolio_ops.plans.claim_movement import (
    ClaimInputs, claim_movement_ledger, exposures_without_rate, merge_ledger, movements_without_rate,
    without_exposures)
from portfolio_ops.plans.homeowners import homeowners_load
from portfolio_ops.plans.key_industry import key_industry
from portfolio_ops.plans.mapping_override import land_mapping_override
from portfolio_ops.plans.policy_delta import PolicyInputs, policy_delta
from portfolio_ops.plans.vault_load import late_for, load_table
from portfolio_ops.plans.vault_model import HUBS, LINKS, SATELLITES, Satellite
from portfolio_ops.schemas import LEDGER, LEDGER_KEYS
from portfolio_ops.session import stage
from portfolio_ops.sources.snapshot import Load, LoadResult, SnapshotTable, publish_together

LEDGER_CONTRACT = Contract(
    not_null=tuple(f.name for f in LEDGER.fields if not f.nullable),
    unique={"LEDGER_KEY": tuple(LEDGER_KEYS)})


def publish_ledger(target: SnapshotTable, inputs: ClaimInputs, latest_run: DataFrame,
                   quarantine: SnapshotTable | None = None) -> LoadResult:
    """A movement without a usable rate fails the load. With a ``quarantine`` table it is
    written there instead, its exposure keeps its stored rows, and the rest is loaded."""
    if quarantine is None:
        ledger = claim_movement_ledger(inputs)
        return target.publish(merge_ledger(target.read(), ledger, latest_run), contract=LEDGER_CONTRACT)
    held = stage(exposures_without_rate(inputs), "held")
    ledger = claim_movement_ledger(without_exposures(inputs, held))
    merged = merge_ledger(target.read(), ledger, latest_run, held)
    return publish_together([Load(target, merged, LEDGER_CONTRACT),
                             Load(quarantine, movements_without_rate(inputs))])[0]


def publish_policy_delta(target: SnapshotTable, inputs: PolicyInputs, stored: DataFrame) -> LoadResult:
    return target.publish(policy_delta(inputs, stored))


def publish_homeowners(targets: Mapping[str, SnapshotTable], feed: DataFrame,
                       section_source: DataFrame) -> list[LoadResult]:
    """Targets by name: policy, section, transaction; with one log they switch at once."""
    made = homeowners_load(feed, section_source)
    return publish_together([Load(targets[n], getattr(made, n))
                             for n in ("policy", "section", "transaction")])


def publish_cession(target: SnapshotTable, premium: DataFrame, marine: DataFrame,
                    weather: DataFrame) -> LoadResult:
    return target.publish(cession_multiplier(premium, marine, weather))


def publish_claim_pairs(target: SnapshotTable, exposures: DataFrame, claims: DataFrame) -> LoadResult:
    return target.publish(claim_binder_pairs(exposures, claims))


def publish_key_industry(target: SnapshotTable, interim: DataFrame) -> LoadResult:
    return target.publish(key_industry(interim, target.read()), mode="append")


def publish_overrides(target: SnapshotTable, records: DataFrame,
                      defaults: Mapping[str, str]) -> LoadResult:
    return target.publish(land_mapping_override(records, defaults), mode="append")


def publish_vault(targets: Mapping[str, SnapshotTable],
                  sources: Mapping[str, DataFrame]) -> list[LoadResult]:
    """Hubs and links grow by appends, satellites are replaced; each is checked against its
    contract, with stored and new rows of its parents. All tables are written and checked
    before the first is switched; with one log they switch at once.

    Satellite rows that come too late are appended to the target ``vault_model.late_name``, those
    that it has not yet; its results follow those of the tables. Without that target they fail
    the load.
    """
    late_loads: list[Load] = []
    loads: dict[str, Load] = {}

    def with_new(name: str) -> DataFrame:
        stored = targets[name].read()
        return stored.unionByName(loads[name].rows.select(stored.columns)) if name in loads else stored

    for table in (*HUBS, *LINKS, *SATELLITES):
        if table.name not in sources:
            continue
        target = targets[table.name]
        rows = load_table(table.name, target.read(), sources[table.name])
        contract = vault_model.contract(table.name)
        parents = {fk.table: with_new(fk.table) for fk in contract.foreign.values()}
        mode = "replace" if isinstance(table, Satellite) else "append"
        loads[table.name] = Load(target, rows, contract, parents, mode)
        if isinstance(table, Satellite):
            late = late_for(table.name, target.read(), sources[table.name])
            kept = targets.get(vault_model.late_name(table.name))
            if kept is not None:
                late_loads.append(Load(kept, late.subtract(kept.read()), mode="append"))
            elif found := late.count():
                raise ContractViolation(f"{table.name} late rows: {found}")
    return publish_together([*loads.values(), *late_loads])
