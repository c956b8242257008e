import datetime as dt
from decimal import Decimal as D

import pytest

from portfolio_ops import schemas as s
from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.plans.homeowners import build_policy, build_sections, clean_feed, homeowners_load, repeated, section_groups


def line(policy, section, number, ref=None, **more):
    base = dict(PK_Policy=policy, FK_Policy=policy, PK_Section=section, PolicyReference=ref or policy, SectionSequenceID=number,
                IsQuote=0, InceptionDate="2019-05-17", CoverageName="c", TriFocus="f", ProductName="Home", YearOfAccount="2019",
                SectionStatus="Bound", PolicyLimit="1000.00", PolicyDeductible="n/a", WrittenOrEstimatedPremium="10",
                ExternalAcquisitionCostPercentage="12.5", InsuredState="NY", UnderwriterName="", OriginalCurrency="USD")
    return {**base, **more}


FEED = [
    line("P1", "P1-1a", 1, ExpiringPolicyReference="X1"),
    line("P1", "P1-1b", 1, WrittenOrEstimatedPremium="5"),                    # later record of the section
    line("P1", "P1-2", 2, InsuredState=None, ProductName=fv.FLOOD_PRODUCT, UnderwriterName=None),
    line("P0", "P0-1", 1, ref="P1"),                                           # older policy key of the reference
    line(None, "", 1, ref="P9"), line("P8", "P8-1", 1, CoverageName="", TriFocus=" "),
    line("P2", "P2-1", 1, InceptionDate="2009-12-31"), line("P3", "P3-1", 1, InceptionDate="2010-01-01", InsuredState="DC"),
    line("P4", "P4-1", 1, IsQuote=1),
]
BINDERS = [dict(FK_YOA=2019, SectionReference=r, SectionReferenceCOBCode=c) for r, c in [
    ("B6188C1A_YH", "YH"), ("B6188C2A-YH", "YH"), ("B6188C1BxYH", "yh"), ("B6188C9AxYH", "ZZ"), ("Z6188C9AxYH", "YH")]]


@pytest.fixture(scope="module")
def tables(make):
    made = homeowners_load(make(s.FEED, FEED), make(s.SECTION_SOURCE, BINDERS))
    return {n: [r.asDict() for r in getattr(made, n).collect()] for n in ("policy", "section", "transaction")}


def test_cleaning(make):
    kept = {r["PK_Section"] for r in clean_feed(make(s.FEED, FEED)).collect()}
    assert kept == {"P1-1a", "P1-1b", "P1-2", "P2-1", "P3-1", "P4-1"}


def test_policy(tables):
    got = {r["PK_Policy"]: r for r in tables["policy"]}
    assert set(got) == {"P1", "P3"}
    assert (got["P1"]["ExpiringPolicyReference"], got["P1"]["PolicyLimit"], got["P1"]["PolicyDeductible"],
            got["P1"]["LimitCurrency"], got["P1"]["InsuredCountry"]) == ("X1", D(1000), D(0), "USD", "USA")


def test_section(tables):
    got = {r["PK_Section"]: r for r in tables["section"]}
    assert set(got) == {"P1-1b", "P1-2", "P3-1"}
    one, two = got["P1-1b"], got["P1-2"]
    assert (one["SectionReference"], one["ExpiringSectionReference"], one["SectionStatus"], one["IsRenewal"]) == ("P1-01", "X1-01", "Live", 1)
    assert one["WrittenOrEstimatedPremium"] == 15 and one["ExternalAcquisitionCostAmount"] == D("0.625")
    assert one["FacilityReference"] == "B6188C2A-YH" and two["FacilityReference"] == "B6188C1BxYH"
    assert (two["SectionLimit"], two["LimitCurrency"], two["DeductibleAmount"]) == (D(1000), "USD", None)
    assert (one["RiskLocation"], two["RiskLocation"], got["P3-1"]["RiskLocation"]) == ("New York", "New York", "DC")
    assert (one["UnderwriterName"], two["UnderwriterName"]) == ("N/A", None)
    assert got["P3-1"]["ExpiringSectionReference"] is None and got["P3-1"]["IsRenewal"] == 0


def test_transaction(tables):
    got = {r["FK_Section"]: r for r in tables["transaction"]}["P1-01"]
    assert (got["AccountingPeriod"], got["DateTimeCreated"]) == (dt.datetime(2019, 5, 1), dt.datetime(2019, 5, 17))
    assert (got["ReceivedPremium"], got["ExternalAcquisitionCostAmount"], got["TaxPayable"]) == (15, D("1.875"), 0)


@pytest.mark.parametrize("column,value", [("PolicyLimit", "abc"), ("WrittenOrEstimatedPremium", ""), ("InceptionDate", "x")])
def test_bad_text_fails(make, column, value):
    with pytest.raises(Exception):
        made = homeowners_load(make(s.FEED, [line("P1", "P1-1", 1, **{column: value})]), make(s.SECTION_SOURCE, BINDERS))
        made.policy.collect(), made.section.collect()


def test_missing_premium_counts_as_zero(make):
    made = homeowners_load(make(s.FEED, [line("P1", "P1-1", 1, WrittenOrEstimatedPremium=None)]), make(s.SECTION_SOURCE, []))
    row = made.transaction.first()
    assert (row["ReceivedPremium"], row["ExternalAcquisitionCostAmount"]) == (0, 0)


def naive_sections(feed, policies):
    """(section, owner reference, limit) by plain loops over all rows."""
    groups = {}
    for r in feed:
        groups.setdefault((r["FK_Policy"], r["SectionSequenceID"]), []).append(r["PK_Section"])
    latest = [max(g) for g in groups.values()]
    out = []
    for r in feed:
        owners = [p for p in policies if p["PK_Policy"] == r["FK_Policy"]]
        for _ in range(latest.count(r["PK_Section"])):
            for o in owners:
                limits = [p["PolicyLimit"] for p in owners] if r["SectionSequenceID"] == 1 else [None]
                out += [(r["PK_Section"], o["PolicyReference"], x) for x in limits]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows,group_rows", [(10_000, 4_000_000), (2, 4_000_000), (1, 3), (3, 2)])
def test_many_policies_of_one_key(make, block_rows, group_rows):
    """n policies of a key meet a section n times and a first section n x n times, in blocks or not."""
    feed = [line("P1", "S1", 1, ref="A", PolicyLimit=str(k % 3)) for k in range(7)]   # ties and repeated rows
    feed += [line("P1", "S2", 2, ref="A"), line("P2", "S3", 1), line("P2", "S4", 2), line("P2", "S0", 2, ref="P2"),
             line("P3", "S5", 1), line("P3", "S4", 2), line("P4", "S6", 2)]           # S4 is latest of two groups
    feed += [line("P5", "S4", 1), line("P5", "S7", 1)]                                # latest, but not of its own group
    rows = make(s.FEED, feed)
    groups = section_groups(rows)
    policy = build_policy(rows, groups)
    got = [(r["PK_Section"], r["PolicyReference"], r["SectionLimit"])
           for r in build_sections(rows, groups, policy, block_rows, group_rows).collect()]
    assert sorted(got, key=repr) == naive_sections(feed, [r.asDict() for r in policy.collect()])
    assert sum(g[0] == "S1" for g in got) == 7 * 7 * 7 and sum(g[0] == "S2" for g in got) == 7


def test_repeated(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 5), ("c", 4)], "v string, times long")
    got = [r["v"] for r in repeated(rows, "times", run=2).collect()]
    assert sorted(got) == ["a"] + ["b"] * 5 + ["c"] * 4


def test_no_array_per_key(make):
    rows = make(s.FEED, FEED)
    plan = build_sections(rows, section_groups(rows), build_policy(rows, section_groups(rows)))
    assert "collect_list" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_only_references_of_several_keys_are_joined(spark):
    from portfolio_ops.operators.dedupe import keep_max_key
    rows = [("a", "k1"), ("a", "k2"), ("a", None), ("b", "k1"), ("b", "k1"), ("c", None), (None, "k1"), (None, "k0")]
    kept = keep_max_key(spark.createDataFrame(rows, "r string, k string"), "r", "k")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "_oldest" in plan
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows if r != ("a", "k1")), key=str)


def test_lines_of_the_feed_are_joined_once(spark):
    """Customers join the orders, so lines meet one table and not two in turn."""
    from types import SimpleNamespace
    from portfolio_ops.analogues.homeowners import feed
    tables = SimpleNamespace(
        lineitem=spark.range(5).selectExpr(
            "id l_orderkey", "id l_partkey", "id l_suppkey", "1 l_linenumber", "1d l_quantity", "1d l_extendedprice",
            "0d l_discount", "0d l_tax", "'N' l_returnflag", "'F' l_linestatus", "timestamp'1995-01-01' l_shipdate"),
        orders=spark.range(5).selectExpr("id o_orderkey", "id o_custkey", "'F' o_orderstatus", "1d o_totalprice",
                                         "timestamp'1995-01-01' o_orderdate", "'5-LOW' o_orderpriority"),
        customer=spark.range(5).selectExpr("id c_custkey", "'BUILDING' c_mktsegment"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feed(tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert len(joins) == 2 and "l_orderkey" in joins[0] and "o_custkey" in joins[1]
