"""Homeowners feed to policy, section and transaction tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.functions.exprs import (
    MONEY, RATE, first_of_month, folded, is_blank, is_true, like_any, map_section_status,
    map_state, numeric_or_zero, same_text, section_suffix, text_in)
from portfolio_ops.operators.change import (
    assign_by_class, fill_from_first, fill_from_group_max, mapping_by_class)
from portfolio_ops.operators.dedupe import keep_max_key, newest_keys
from portfolio_ops.operators.filters import delete_where
from portfolio_ops.operators.ordered import GROUP_ROWS, Ordered, ordered_groups
from portfolio_ops.session import stage

# policies of one key that meet a section in one task; sets locality, never the rows
POLICY_BLOCK = 10_000


class HomeownersTables:
    """The three outputs, each made when it is asked for. What several of them read is staged
    once: the cleaned feed, the section groups, the policies and the sections."""

    def __init__(self, feed: DataFrame, section_source: DataFrame):
        self._feed, self._section_source = feed, section_source

    @cached_property
    def cleaned(self) -> DataFrame:
        return stage(clean_feed(self._feed), "feed")

    @cached_property
    def groups(self) -> DataFrame:
        return stage(section_groups(self.cleaned), "groups")

    @cached_property
    def policy(self) -> DataFrame:
        return stage(build_policy(self.cleaned, self.groups), "policy")

    @cached_property
    def section(self) -> DataFrame:
        sections = stage(build_sections(self.cleaned, self.groups, self.policy), "sections")
        return finish_sections(sections, binder_mapping(self._section_source))

    @cached_property
    def transaction(self) -> DataFrame:
        return derive_transactions(self.section)


def money(name: str) -> Column:
    return F.col(name).cast(MONEY)


def rate(name: str) -> Column:
    return F.col(name).cast(RATE)


def clean_feed(feed: DataFrame) -> DataFrame:
    rows = delete_where(feed, F.col("PK_Policy").isNull() & is_blank("PK_Section"))
    rows = delete_where(rows, is_blank("CoverageName") & is_blank("TriFocus"))
    compared = ("PolicyReference", "PK_Policy", folded("PolicyReference"), folded("PK_Policy"))
    # staged, so that what finds them is off the disk when wide rows move
    return keep_max_key(rows, *compared, newest=stage(newest_keys(rows, *compared), "newest"))


def binder_mapping(sections: DataFrame) -> DataFrame:
    """Binder reference per year, from sections of the binder's two classes."""
    return (sections.filter(like_any("SectionReference", [fv.BINDER_PREFIX], ignore_case=True)
                            & text_in("SectionReferenceCOBCode", fv.BINDER_CLASS_CODES))
            .select(F.col("FK_YOA").alias("YOA"), F.col("SectionReference").alias("BinderReference")))


def section_groups(feed: DataFrame) -> DataFrame:
    """Latest record and premium total per (policy, section number), in one aggregate."""
    return feed.groupBy(folded("FK_Policy").alias("_f"), F.col("SectionSequenceID").alias("_q")).agg(
        F.max(folded("PK_Section")).alias("_latest"), F.sum(money("WrittenOrEstimatedPremium")).alias("_premium"))


def build_policy(feed: DataFrame, groups: DataFrame) -> DataFrame:
    latest = groups.filter(F.col("_q") == 1).select("_latest")
    expiring = (feed.groupBy(folded("PK_Policy").alias("_pk"))
                .agg(F.max(F.struct(folded("ExpiringPolicyReference"), "ExpiringPolicyReference"))
                     ["ExpiringPolicyReference"].alias("_expiring")))
    rows = (feed.filter(F.col("PK_Policy").isNotNull() & (F.col("IsQuote") == 0))
            .filter(F.year(F.col("InceptionDate").cast("timestamp_ntz")) >= fv.FIRST_UNDERWRITING_YEAR)
            .join(latest, folded("PK_Section") == F.col("_latest"))
            .join(expiring, folded("PK_Policy") == F.col("_pk")))
    return rows.select(
        "PK_Policy", "PolicyReference", "IsQuote",
        F.col("_expiring").alias("ExpiringPolicyReference"), "IsAdmitted",
        F.lit("").alias("PlacingBrokerGroup"), "PlacingBrokerContact", "PlacingBrokerState",
        "PlacingBrokerBranchName", "InsuredName", "InsuredCity", "InsuredState",
        F.lit(fv.HOMEOWNERS_COUNTRY).alias("InsuredCountry"),
        F.lit(fv.HOMEOWNERS_SEGMENT).alias("MarketSegment"), "UniqueMarketReference",
        money("PolicyLimit").alias("PolicyLimit"),
        numeric_or_zero("PolicyDeductible").alias("PolicyDeductible"),
        F.coalesce("PolLimitCurrency", F.lit(fv.DEFAULT_LIMIT_CURRENCY)).alias("LimitCurrency"),
        "YearOfAccount", "BrokerBeazleyTradeId")


def policy_blocks(policy: DataFrame, block_rows: int = POLICY_BLOCK,
                  group_rows: int = GROUP_ROWS) -> DataFrame:
    """What sections take from policies, each row in a numbered block of its key, with the
    number of blocks of the key, mostly one. No key's policies are gathered in one row."""
    taken = {"_reference": "PolicyReference", "_expiring": "ExpiringPolicyReference", "_year": "YearOfAccount",
             "_limit": "PolicyLimit", "_limit_currency": "LimitCurrency", "_deductible": "PolicyDeductible"}
    rows = policy.select(folded("PK_Policy").alias("_p"), *[F.col(n).alias(out) for out, n in taken.items()])
    placed = ordered_groups(rows, Ordered(["_p"], [F.col(n) for n in taken], position="_place",
                                          group_size="_size"), group_rows)
    return placed.select("_p", *taken,
                         F.floor((F.col("_place") - 1) / block_rows).cast("int").alias("_block"),
                         F.ceil(F.col("_size") / block_rows).cast("int").alias("_blocks"))


def repeated(df: DataFrame, times: str, run: int = POLICY_BLOCK) -> DataFrame:
    """Each row as often as ``times`` says, by two sequences, so that none is longer than the
    count over ``run`` or than ``run``."""
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / run))
    left = F.least(F.lit(run).cast("long"), F.col(times) - F.col("_run") * run)
    return (df.withColumn("_run", F.explode(runs))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
            .drop("_run", "_copy", times))


def latest_records(feed: DataFrame, groups: DataFrame, per_key: DataFrame) -> DataFrame:
    """Records that are the latest of a section group, once for each such group, with the premium
    of their own group and the number of policy blocks of their key.

    Which records these are follows from their keys alone; the wide rows are joined once, when the keys
    are staged and their shuffles gone.
    """
    per_latest = (groups.filter(F.col("_latest").isNotNull()).groupBy(F.col("_latest").alias("_key"))
                  .agg(F.count(F.lit(1)).alias("_times")))
    record, own, number = folded("PK_Section"), folded("FK_Policy"), F.col("SectionSequenceID")
    known = groups.select("_f", "_q", "_premium").join(per_key, F.col("_f") == F.col("_p")).drop("_f")
    hits = (feed.select(own.alias("_of"), number.alias("_oq"), record.alias("_record")).distinct()
            .join(known, (F.col("_of") == F.col("_p")) & (F.col("_oq") == F.col("_q"))).drop("_of", "_oq")
            .join(per_latest, F.col("_record") == F.col("_key")).drop("_key"))
    hits = stage(hits, "hits")
    rows = feed.join(hits, (own == F.col("_p")) & (number == F.col("_q")) & (record == F.col("_record")))
    return repeated(rows.drop("_q", "_record"), "_times")


def build_sections(feed: DataFrame, groups: DataFrame, policy: DataFrame,
                   block_rows: int = POLICY_BLOCK, group_rows: int = GROUP_ROWS) -> DataFrame:
    """A section meets every policy of its key, the first section also every limit of them.

    Policies of a key meet sections in blocks: a section is copied to each block of owners, a
    first section to each pair of an owner and a limit block, so that many policies of one key
    spread over tasks. A key of few policies has one block and its sections one copy.
    """
    first = F.col("SectionSequenceID") == 1
    blocks = policy_blocks(policy, block_rows, group_rows)
    per_key = blocks.groupBy("_p").agg(F.max("_blocks").alias("_blocks"))
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    owners = blocks.select(F.col("_p").alias("_op"), F.col("_block").alias("_oo"), F.explode(every).alias("_ol"),
                           "_reference", "_expiring", "_year")
    limits = blocks.select(F.col("_p").alias("_lp"), F.explode(every).alias("_lo"), F.col("_block").alias("_ll"),
                           "_limit", "_limit_currency", "_deductible")
    rows = (latest_records(feed, groups, per_key)
            .withColumn("_owner", F.explode(every))
            .withColumn("_limited", F.explode(F.when(first, every).otherwise(F.array(F.lit(0)))))
            .join(owners, (F.col("_p") == F.col("_op")) & (F.col("_owner") == F.col("_oo"))
                  & (F.col("_limited") == F.col("_ol")))
            .join(limits, first & (F.col("_p") == F.col("_lp")) & (F.col("_owner") == F.col("_lo"))
                  & (F.col("_limited") == F.col("_ll")), "left"))
    own = ["CoverageName", "InceptionDate", "ExpiryDate"]
    return rows.select(
        "PK_Section", F.col("_reference").alias("PolicyReference"),
        section_suffix("_reference", "SectionSequenceID").alias("SectionReference"),
        "SectionSequenceID", *own,
        map_section_status("SectionStatus").alias("SectionStatus"),
        section_suffix("_expiring", "SectionSequenceID").alias("ExpiringSectionReference"),
        "FacilityReference", "TriFocus", "ClassOfBusinessCode", "BindDate", "ProductName",
        F.col("_expiring").isNotNull().cast("int").alias("IsRenewal"),
        "Peril", "LloydsRiskCode", map_state("InsuredState").alias("RiskLocation"),
        F.when(F.rtrim("UnderwriterName") == "", F.lit("N/A")).otherwise(F.col("UnderwriterName"))
        .alias("UnderwriterName"),
        "OfficeLocation", "LeadInsurerPseudo", "TermsOfTradeDate", "IsSigned",
        money("WrittenLine").alias("WrittenLine"),
        *[rate(n).alias(n) for n in ("WrittenOrder", "SignedLine", "SignedOrder", "EstimatedSigning")],
        F.col("_premium").alias("WrittenOrEstimatedPremium"),
        F.col("_limit").alias("SectionLimit"), money("EventLimit").alias("EventLimit"),
        "LimitQualifier", F.col("_limit_currency").alias("LimitCurrency"), "OriginalCurrency",
        "SettlementCurrency", money("ExcessAmount").alias("ExcessAmount"),
        money("ExcessQualifier").alias("ExcessQualifier"),
        F.col("_deductible").alias("DeductibleAmount"),
        money("DeductiblePercentage").alias("DeductiblePercentage"),
        F.lit(fv.DEDUCTIBLE_QUALIFIER).alias("DeductibleQualifier"),
        rate("ExternalAcquisitionCostPercentage").alias("ExternalAcquisitionCostPercentage"),
        (money("ExternalAcquisitionCostPercentage") * F.col("WrittenOrEstimatedPremium").cast(MONEY) / 100)
        .alias("ExternalAcquisitionCostAmount"),
        *[money(n).alias(n) for n in (
            "InternalAcquisitionCostPercentage", "InternalAcquisitionCostAmount",
            "RateChangePercentage", "BenchmarkPremiumPercentage", "BenchmarkPremiumAmount",
            "OriginalToSettlementCurrencyRate", "LimitToSettlementCurrencyRate")],
        "InsuredItemNarrative", F.col("OccupancyDescription").alias("Occupation"),
        F.col("_year").cast("int").alias("YearOfAccount"))


def binder_rule(old: Column, a: Column, b: Column, c: Column) -> Column:
    """Facility reference by product; a missing mapping keeps the old value.

    Wind before the switch year prefers the general binder. Products or focus that
    are missing are unknown to the last rule and keep their value.
    """
    flood = same_text("ProductName", fv.FLOOD_PRODUCT)
    wind = same_text("ProductName", fv.WIND_PRODUCT)
    other = F.col("ProductName").isNotNull() & ~same_text("TriFocus", fv.EXCLUDED_TRIFOCUS)
    return (F.when(flood, F.coalesce(b, old))
            .when(wind & (F.col("YearOfAccount") < fv.WIND_SWITCH_YEAR), F.coalesce(a, c, old))
            .when(wind, F.coalesce(c, old))
            .when(is_true(other), F.coalesce(a, old))
            .otherwise(old))


def assign_binder(sections: DataFrame, mapping: DataFrame) -> DataFrame:
    classes = {f"_binder_{letter}": [f"%{letter}{suffix}" for suffix in fv.BINDER_SUFFIXES]
               for letter in "ABC"}
    by_year = mapping_by_class(mapping, "YOA", "BinderReference", classes, ignore_case=True)
    rule = binder_rule(F.col("FacilityReference"), *[F.col(n) for n in classes])
    return assign_by_class(sections, by_year, F.col("YearOfAccount"), "FacilityReference", rule)


def derive_transactions(sections: DataFrame) -> DataFrame:
    premium = F.coalesce(money("WrittenOrEstimatedPremium"), F.lit(0).cast(MONEY))
    percent = F.coalesce(money("ExternalAcquisitionCostPercentage"), F.lit(0).cast(MONEY))
    return sections.select(
        F.col("SectionReference").alias("FK_Section"), "SectionReference",
        first_of_month("InceptionDate").alias("AccountingPeriod"),
        F.col("InceptionDate").cast("timestamp_ntz").alias("DateTimeCreated"),
        F.lit(fv.TRANSACTION_CLASS).alias("TransactionClass"),
        premium.alias("ReceivedPremium"), percent.alias("ExternalAcquisitionCostPercentage"),
        (premium * percent / 100).alias("ExternalAcquisitionCostAmount"),
        "OriginalCurrency", "SettlementCurrency", F.lit(0).alias("TaxPayable"),
        F.lit(None).cast("string").alias("TaxLocation"), "OriginalToSettlementCurrencyRate",
        F.col("SectionReference").alias("SourceSystemKey"))


def finish_sections(sections: DataFrame, mapping: DataFrame) -> DataFrame:
    rows = assign_binder(sections, mapping)
    rows = fill_from_first(rows, folded("PolicyReference"), F.col("SectionSequenceID") == 1,
                           "SectionLimit", ["SectionLimit", "LimitCurrency"])
    return fill_from_group_max(rows, folded("PolicyReference"), "RiskLocation")


def homeowners_load(feed: DataFrame, section_source: DataFrame) -> HomeownersTables:
    return HomeownersTables(feed, section_source)
