"""Claim-movement ledger: ordered movements with running outstanding balances.

Stages: recorded movements joined to their claim, one opening row per exposure that
needs it, positions inside (exposure, currency), sign and rate rules, running
balances, group numbers, row hash. The ledger is then merged into the stored table.

Partitioning: movements, extensions and exposures are each shuffled once on the
exposure; joins, numbering, positions and balances all run where that puts them.
Exposures too large for one task take the segmented way (see ``operators.ordered``).
Group numbers follow from the ledger's keys alone: a narrow pass finds these, and the
numbers come in with the exposures, so that no wide row is moved or written for them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.functions.exprs import (
    MONEY, RATE, RATIO, flag_off, flag_on, is_empty, is_true, negate_where,
    reporting_currency, required, settlement_to_usd, zero_to_one)
from portfolio_ops.functions.hashing import row_hash
from portfolio_ops.operators.change import merge_by_hash
from portfolio_ops.operators.dedupe import latest_per_key
from portfolio_ops.operators.lookups import with_one_row
from portfolio_ops.operators.ordered import (
    GROUP_ROWS, Ordered, balance_columns, large_groups, plain, reverse_position, split_by)
from portfolio_ops.operators.ranking import key_ranks
from portfolio_ops.schemas import (
    LEDGER, LEDGER_KEYS, LEDGER_TABLE, MOVEMENT, MOVEMENT_EXT, OUTSTANDING, PAID, PARTS, SIDE_AMOUNTS,
    TO_DATE, amounts)
from portfolio_ops.session import stage
from portfolio_ops.sources.landing import with_lineage
from portfolio_ops.sources.snapshot import select_for

Windowing = Callable[[DataFrame, Ordered], DataFrame]
EXPOSURE = "claim_exposure_source_id"


@dataclass(frozen=True)
class ClaimInputs:
    movement: DataFrame
    movement_ext: DataFrame
    exposure: DataFrame
    exposure_ext: DataFrame
    claim: DataFrame
    exchange_rate: DataFrame


def _zero() -> Column:
    return F.lit(0).cast(MONEY)


def usd_ratios(exchange_rate: DataFrame) -> DataFrame:
    """Latest rate per currency, inverted."""
    latest = latest_per_key(exchange_rate.filter(F.col("rate_type_id") == fv.RATE_TYPE_ID),
                            ["currency_code_name"], ["effective_from_date", "id"])
    return latest.select(F.col("currency_code_name").alias("_currency"),
                         (F.lit(1) / F.col("rate_to_usd")).cast(RATIO).alias("_ratio"))


def live_exposures(inputs: ClaimInputs) -> DataFrame:
    """Active exposures of open, real claims, with the market reference if any."""
    ours = F.col("source_system") == fv.CLAIM_SOURCE
    claim = (inputs.claim.filter(flag_on("is_active") & flag_off("incident_report")
                                 & flag_off("is_retired") & ours).select("claim_source_id"))
    ext = inputs.exposure_ext.filter(flag_on("is_active") & ours).select(EXPOSURE, "scm_reference")
    return (inputs.exposure.filter(flag_on("is_active") & ours)
            .select(EXPOSURE, "claim_source_id", "exposure_opened_date", "signed")
            .join(claim, "claim_source_id").drop("claim_source_id").join(ext, EXPOSURE, "left"))


MOVEMENT_JOIN = [EXPOSURE, "movement_reference_source_id", "sequence_number",
                 "original_currency", "settlement_currency"]


def join_near(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The inner join on ``keys``, by one exchange on the first of them.

    A join on all keys would place rows by all of them, and every wide row would move again for the
    windows and joins of its exposure. Here both tables are placed by the exposure and the rows of
    one key meet in a window. Not for exposures too large for one task.
    """
    sides = {"_l": left.select(*[n for n in left.columns if n not in keys]),
             "_r": right.select(*[n for n in right.columns if n not in keys])}
    tagged = [df.dropna(subset=list(keys)).select(*keys, *[
        (F.struct(*side.columns) if name == own else F.lit(None)).cast(side.schema).alias(name)
        for name, side in sides.items()]) for own, df in (("_l", left), ("_r", right))]
    met = tagged[0].unionByName(tagged[1]).repartition(keys[0]).withColumn(
        "_all", F.collect_list("_r").over(Window.partitionBy(*keys)))
    return (met.filter(F.col("_l").isNotNull()).select(*keys, "_l", F.explode("_all").alias("_r"))
            .select(*keys, "_l.*", "_r.*"))


def _with_rate(inputs: ClaimInputs, live: DataFrame | None = None, near: bool = False) -> DataFrame:
    """Accepted movements with their extension and conversion rate; of ``live`` exposures, if given."""
    # every row is of one source system, so that is no key of the joins
    ours = (F.col("source_system") == fv.CLAIM_SOURCE) & flag_on("is_active")
    ext = inputs.movement_ext.filter(ours).drop("is_active", "source_system")
    migrated = F.col("movement_type") == fv.MIGRATED_TYPE
    completed = F.coalesce("transfer_status", F.lit("")).isin(fv.COMPLETED_STATUSES)
    rows = inputs.movement.filter(ours).drop("is_active")
    rows = join_near(rows, ext, MOVEMENT_JOIN) if near else rows.join(ext, MOVEMENT_JOIN)
    rows = rows.filter(migrated | (~migrated & completed))
    if live is not None:
        rows = rows.join(live, EXPOSURE)
    ratios = usd_ratios(inputs.exchange_rate)
    return (rows.join(ratios, F.col("settlement_currency") == F.col("_currency"), "left")
            .withColumn("_usd_rate", settlement_to_usd(
                "settlement_currency", "original_ccy_to_group_ccy_rate", "_ratio")))


def movements_without_rate(inputs: ClaimInputs) -> DataFrame:
    """Accepted movements that cannot be converted (the quarantine output)."""
    return _with_rate(inputs).filter(F.col("_usd_rate").isNull()).select(
        *[n for n in inputs.movement.columns if n != "is_active"])


def exposures_without_rate(inputs: ClaimInputs) -> DataFrame:
    """Exposures with a movement that cannot be converted."""
    return movements_without_rate(inputs).select(EXPOSURE).distinct()


def without_exposures(inputs: ClaimInputs, held: DataFrame) -> ClaimInputs:
    """Inputs without these exposures. Their movements go together: positions and balances
    of an exposure need all of its movements."""
    return replace(inputs, movement=inputs.movement.join(held, EXPOSURE, "left_anti"),
                   exposure=inputs.exposure.join(held, EXPOSURE, "left_anti"))


# amounts and rates of a movement that only those of the market scheme use
SCHEME_ONLY = [f"movement_{kind}_in_original_ccy" for p in PARTS for kind in (f"reserve_{p}_amount", f"paid_{p}")] + [
    "outstanding_original_ccy_to_settlement_ccy_rate", "paid_original_ccy_to_settlement_ccy_rate"]


def recorded_movements(inputs: ClaimInputs, live: DataFrame, window: Windowing) -> DataFrame:
    is_scm = F.col("movement_type") == fv.MIGRATED_TYPE
    movement = inputs.movement.select(*[n for n in MOVEMENT.fieldNames() if n != "source_system_event_date_time"])
    needed = replace(inputs, movement=movement.withColumns({n: F.when(is_scm, F.col(n)) for n in SCHEME_ONLY}),
                     movement_ext=inputs.movement_ext.select(*MOVEMENT_EXT.fieldNames()))
    rows = _with_rate(needed, live.select(EXPOSURE, "scm_reference", "_groups"), near=window is plain)
    rows = rows.withColumn("_when", F.coalesce("movement_period", "movement_date"))
    order = ["_when", "movement_date", "sequence_number", "movement_reference_source_id",
             "settlement_currency", "original_currency"]
    rows = window(rows, Ordered([EXPOSURE], [F.col(n).asc_nulls_last() for n in order],
                                position="_number"))

    scm = F.col("movement_type") == fv.MIGRATED_TYPE

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name).cast(MONEY), _zero())

    def rate(name: str) -> Column:
        return (F.when(scm, F.coalesce(F.col(name), F.lit(1).cast(RATE)))
                .otherwise(F.lit(1).cast(RATE)).alias(name))

    measures = []
    for p in PARTS:
        reserved = or_zero(f"to_date_outstanding_{p}_in_reserving_ccy")
        paid = or_zero(f"to_date_paid_{p}_in_reserving_ccy")
        measures += [
            F.when(scm, or_zero(f"movement_reserve_{p}_amount_in_original_ccy")).otherwise(_zero())
            .alias(f"{TO_DATE}_{p}_in_original_ccy"),
            F.when(scm, reserved).otherwise(_zero()).alias(f"{TO_DATE}_{p}_in_source_settlement_ccy"),
            F.when(scm, or_zero(f"movement_paid_{p}_in_original_ccy")).otherwise(paid)
            .alias(f"{PAID}_{p}_in_original_ccy"),
            paid.alias(f"{PAID}_{p}_in_source_settlement_ccy"),
            reserved.alias(f"{OUTSTANDING}_{p}_in_original_ccy"),
            reserved.alias(f"{OUTSTANDING}_{p}_in_source_settlement_ccy"),
            reserved.alias(f"{p}_reserve_in_settlement_ccy"),
        ]
    return rows.select(
        F.col(EXPOSURE).alias("exposure_reference"), F.col("_number").alias("sequence_number"),
        F.when(is_empty("scm_reference"), F.coalesce("movement_type", F.lit("")))
        .otherwise(F.col("movement_reference_source_id")).alias("movement_reference"),
        reporting_currency("settlement_currency").alias("settlement_currency"),
        F.col("settlement_currency").alias("settlement_source_currency"),
        F.coalesce(F.when(scm, F.col("original_currency")).when(~scm, F.col("settlement_currency")),
                   F.lit(fv.REPORTING_CURRENCY)).alias("original_currency"),
        required("_usd_rate", "exchange rate of the settlement currency").alias("_usd_rate"),
        rate("outstanding_original_ccy_to_settlement_ccy_rate"),
        rate("paid_original_ccy_to_settlement_ccy_rate"),
        "movement_date", *measures,
        F.coalesce("movement_type", F.lit("")).alias("movement_type"),
        F.when(scm, F.lit(True)).otherwise(F.col("does_not_erode_reserves"))
        .alias("does_not_erode_reserves"),
        "payment_id", "payment_type", "signed_line", "transaction_tracking_status",
        "transfer_status",
        *[F.col(n.removeprefix("movement_")).alias(n) for n in SIDE_AMOUNTS],
        F.coalesce("transaction_created_on", "movement_date").alias("movement_creation_date"), "_groups")


def first_movements(movement: DataFrame) -> DataFrame:
    """First-numbered movement per exposure by event time, ranked before the active filter.

    ``_any_active`` tells whether any first-numbered movement is active: an exposure
    whose first row is inactive while another one is active gets no opening row.
    """
    rows = movement.filter((F.col("source_system") == fv.CLAIM_SOURCE) & (F.col("sequence_number") == 1))
    # latest first, a missing time before all; then the smallest, missing values last
    event = F.col("source_system_event_date_time")
    order = [event.isNotNull(), -F.unix_micros(event)]
    for name in ("movement_reference_source_id", "settlement_currency", "original_currency"):
        order += [F.col(name).isNull(), F.col(name)]
    top = F.struct(flag_on("is_active").alias("_first_active"), "movement_date", "movement_type",
                   "settlement_currency", "original_currency")
    return rows.groupBy(EXPOSURE).agg(
        F.min_by(top, F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)])).alias("_top"),
        F.max(flag_on("is_active")).alias("_any_active")).select(EXPOSURE, "_top.*", "_any_active")


def _opened(inputs: ClaimInputs, live: DataFrame) -> DataFrame:
    """Exposures outside the market scheme that get an opening row, with their first movement."""
    first = first_movements(inputs.movement).filter(F.col("_any_active"))
    seen = F.col("_any_active").isNotNull()
    return (live.filter(is_empty("scm_reference"))
            .join(first, EXPOSURE, "left")
            .filter(~seen | F.col("_first_active"))
            .filter(F.col("movement_date").isNull()
                    | is_true(F.col("movement_type") != fv.MIGRATED_TYPE)))


def opening_rows(inputs: ClaimInputs, live: DataFrame) -> DataFrame:
    """One zero row for every exposure outside the market scheme."""
    rows = _opened(inputs, live)
    one, no_text = F.lit(1).cast(RATE), F.lit(None).cast("string")
    zeros = [_zero().alias(f"{stem}_{p}_in_{ccy}_ccy") for stem in (TO_DATE, PAID, OUTSTANDING)
             for p in PARTS for ccy in ("original", "source_settlement")]
    return rows.select(
        F.col(EXPOSURE).alias("exposure_reference"), F.lit(0).cast("long").alias("sequence_number"),
        F.lit(fv.DUMMY_REFERENCE).alias("movement_reference"),
        reporting_currency("settlement_currency").alias("settlement_currency"),
        F.col("settlement_currency").alias("settlement_source_currency"),
        F.coalesce("original_currency", F.lit(fv.REPORTING_CURRENCY)).alias("original_currency"),
        F.lit(1).cast(RATIO).alias("_usd_rate"),
        one.alias("outstanding_original_ccy_to_settlement_ccy_rate"),
        one.alias("paid_original_ccy_to_settlement_ccy_rate"),
        F.col("exposure_opened_date").alias("movement_date"), *zeros,
        *[F.lit(None).cast(MONEY).alias(f"{p}_reserve_in_settlement_ccy") for p in PARTS],
        F.lit(fv.DUMMY_TYPE).alias("movement_type"),
        F.lit(True).alias("does_not_erode_reserves"),
        no_text.alias("payment_id"), no_text.alias("payment_type"),
        F.col("signed").alias("signed_line"),
        no_text.alias("transaction_tracking_status"), no_text.alias("transfer_status"),
        *[F.lit(0).cast("decimal(20,4)").alias(n) for n in SIDE_AMOUNTS],
        F.col("exposure_opened_date").alias("movement_creation_date"), "_groups")


# sort columns inside (exposure, currency): places are given in this order
PLACE_ORDER = ["_scm_date", "_switch", "sequence_number", "movement_reference", "original_currency"]


def with_place_order(rows: DataFrame) -> DataFrame:
    """Sort columns of market scheme movements; others have none of these and come last."""
    scm = F.col("movement_type") == fv.MIGRATED_TYPE
    switch = None
    for pattern, place in fv.SWITCH_ORDER.items():
        test = scm & F.col("movement_reference").like(pattern)
        switch = F.when(test, place) if switch is None else switch.when(test, place)
    return rows.withColumns({"_scm_date": F.when(scm, F.col("movement_date")), "_switch": switch})


def with_amount_rules(rows: DataFrame) -> DataFrame:
    """Defaults, conversion, zero rates and recovery signs."""
    converted = {f"{stem}_{p}_in_settlement_ccy":
                 (F.col(f"{stem}_{p}_in_source_settlement_ccy") * F.col("_usd_rate")).cast(MONEY)
                 for stem in (TO_DATE, PAID, OUTSTANDING) for p in PARTS}
    filled = {n: F.coalesce(n, F.lit(0).cast("decimal(20,4)")) for n in SIDE_AMOUNTS}
    rows = rows.withColumns({
        **converted, **filled,
        "movement_date": F.coalesce("movement_date",
                                    F.lit(fv.MISSING_MOVEMENT_DATE).cast("timestamp")),
        "does_not_erode_reserves": F.coalesce("does_not_erode_reserves", F.lit(False)),
        **{n: zero_to_one(n).cast(RATE) for n in (
            "outstanding_original_ccy_to_settlement_ccy_rate",
            "paid_original_ccy_to_settlement_ccy_rate")},
    })
    return rows.withColumns(negate_where([*amounts(PAID), *SIDE_AMOUNTS],
                                         F.col("movement_type") == fv.RECOVERY_TYPE))


def with_places_and_balances(rows: DataFrame, window: Windowing) -> DataFrame:
    """Position inside (exposure, currency), the reversed position, and the running outstanding
    balance of movements outside the market scheme, from one window.

    Scheme movements have no flow: they neither take part in the balance nor change. Only
    eroding payments reduce it.
    """
    scm = F.col("movement_type") == fv.MIGRATED_TYPE
    eroding = (F.col("movement_type") == fv.PAYMENT_TYPE) & ~F.col("does_not_erode_reserves")
    measures = {}
    for to_date, inflow, paid in zip(amounts(TO_DATE), amounts(OUTSTANDING), amounts(PAID)):
        out = F.when(eroding, F.col(paid)).otherwise(_zero())
        measures[to_date] = (to_date, F.col(inflow) - out)
    flows, running = balance_columns(measures)
    placed = window(rows.withColumns({n: F.when(~scm, flow) for n, flow in flows.items()}), Ordered(
        ["exposure_reference", "settlement_currency"], [F.col(n).asc_nulls_last() for n in PLACE_ORDER],
        position="movement_group_sequence_id", group_size="_group_rows", running=running))
    balances = {n: F.when(scm, F.col(n)).otherwise(F.col(f"_run_{n}") - F.col(n)).cast(MONEY) for n in measures}
    back = reverse_position("movement_group_sequence_id", "_group_rows")
    return placed.withColumns({**balances, "sequence_number_order_id": back}).drop(
        "_scm_date", "_switch", "_group_rows", *flows, *running)


def ledger_keys(inputs: ClaimInputs, live: DataFrame, near: bool = True) -> DataFrame:
    """(exposure, currency) of every ledger row, without the rows; a missing rate is an error."""
    key = [F.col(EXPOSURE).alias("exposure_reference"),
           reporting_currency("settlement_currency").alias("settlement_currency")]
    rate = required("_usd_rate", "exchange rate of the settlement currency")
    flags = [*MOVEMENT_JOIN, "source_system", "is_active"]
    narrow = replace(inputs, movement_ext=inputs.movement_ext.select(*flags, "transfer_status"), movement=inputs
                     .movement.select(*flags, "movement_type", "original_ccy_to_group_ccy_rate"))
    recorded = _with_rate(narrow, live.select(EXPOSURE).distinct(), near).filter(rate.isNotNull()).select(*key)
    return recorded.unionByName(_opened(inputs, live).select(*key)).distinct()


def with_group_ids(live: DataFrame, ranks: DataFrame) -> DataFrame:
    """Exposures with the group number of each of their (at most ``KEPT_CURRENCIES``) currencies."""
    groups = ranks.groupBy(F.col("exposure_reference").alias("_of")).agg(F.map_from_entries(
        F.collect_list(F.struct("settlement_currency", "movement_group_id"))).alias("_groups"))
    return live.join(groups, F.col(EXPOSURE).eqNullSafe(F.col("_of")), "left").drop("_of")


def ledger_rows(inputs: ClaimInputs, live: DataFrame, window: Windowing) -> DataFrame:
    rows = recorded_movements(inputs, live, window).unionByName(opening_rows(inputs, live))
    numbered = rows.withColumn("movement_group_id", F.col("_groups")[F.col("settlement_currency")]).drop("_groups")
    return with_places_and_balances(with_amount_rules(with_place_order(numbered)), window)


def claim_movement_ledger(inputs: ClaimInputs, missing_rate: str = "raise",
                          group_rows: int = GROUP_ROWS) -> DataFrame:
    """The ledger without audit columns.

    ``missing_rate="quarantine"`` holds back every exposure that has a movement without a usable
    rate (``movements_without_rate`` returns those); by default such a movement is an error.
    """
    if missing_rate == "quarantine":
        inputs = without_exposures(inputs, stage(exposures_without_rate(inputs), "held"))
    live = stage(live_exposures(inputs), "live")
    large = large_groups(inputs.movement, [EXPOSURE], group_rows)
    keys = stage(ledger_keys(inputs, live, near=large is None), "keys")
    live = with_group_ids(live, key_ranks(keys, ["exposure_reference", "settlement_currency"],
                                          "movement_group_id"))
    if large is None:
        rows = ledger_rows(inputs, live.repartition(EXPOSURE), plain)
    else:
        # movements without an exposure reach no ledger row, so plain equality will do for them
        few, many = (inputs.movement.join(large.keys, EXPOSURE, how) for how in ("left_anti", "left_semi"))
        few_live, many_live = split_by(live, large.keys, [EXPOSURE])
        rows = ledger_rows(replace(inputs, movement=few), few_live.repartition(EXPOSURE), plain)
        rows = rows.unionByName(ledger_rows(replace(inputs, movement=many), many_live, large.segmented))
    return select_for(rows, LEDGER)


def ledger_source(ledger: DataFrame, latest_run: DataFrame) -> DataFrame:
    """Ledger rows with hash and audit columns, ready to merge."""
    hashed = ledger.withColumn("row_hash_key", row_hash(ledger, LEDGER.fieldNames()))
    run = with_one_row(hashed, latest_run.select(F.col("id").alias("process_id")), ["process_id"])
    return with_lineage(run, F.col("process_id"), fv.LEDGER_SOURCE_NAME, fv.LEDGER_CREATED_FROM)


# set on insert only: keys, the unconverted currency, and the created_* columns
LEDGER_UPDATES = [n for n in LEDGER.fieldNames()
                  if n not in (*LEDGER_KEYS, "settlement_source_currency")] + ["process_id", "source_name"]


def merge_ledger(stored: DataFrame, ledger: DataFrame, latest_run: DataFrame,
                 held: DataFrame | None = None) -> DataFrame:
    """The stored table after the load: changed, new and vanished keys applied.

    Stored rows of ``held`` exposures stay as they are: those were left out of the ledger,
    they have not vanished.
    """
    if held is None:
        # a ledger that has its hashes is a stored source already
        source = ledger if "row_hash_key" in ledger.columns else stage(ledger_source(ledger, latest_run), "merged")
        return select_for(merge_by_hash(stored, source, LEDGER_KEYS, "row_hash_key", LEDGER_UPDATES),
                          LEDGER_TABLE)
    names = held.select(F.col(EXPOSURE).alias("exposure_reference"))
    merged = merge_ledger(stored.join(names, "exposure_reference", "left_anti"), ledger, latest_run)
    return merged.unionByName(select_for(stored.join(names, "exposure_reference", "left_semi"), LEDGER_TABLE))
