"""One test per comparison, NULL, number and text rule."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from portfolio_ops.functions import exprs as x
from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.functions.hashing import hash_key, joined_text, row_hash
from portfolio_ops.plans.homeowners import binder_rule
from portfolio_ops.operators.focus import trifocus_name


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()], F.lit(0).alias("_"))
    return row.select(column).first()[0]


def test_text_compare_ignores_case_and_trailing_blanks(spark):
    for name in ("GameChanger", "Gamechanger ", "GAMECHANGER"):
        assert one(spark, x.source_priority("s"), s=name) == 1
        assert one(spark, x.same_text("s", "GameChanger"), s=name)
    assert one(spark, x.source_priority("s"), s="fdr") == 2
    assert one(spark, x.source_priority("s"), s="zzz") == 3


def test_missing_origin_literal_keeps_its_backslash(spark):
    assert len(fv.MISSING_ORIGIN) == 3 and one(spark, F.length(F.lit(fv.MISSING_ORIGIN))) == 3


def test_underscore_is_a_wildcard(spark):
    assert one(spark, x.like_any("b", ["%A_YH"]), b="B1A-YH")
    assert not one(spark, x.like_any("b", ["%A_YH"]), b="B1AYH")


@pytest.mark.parametrize("text,value", [("n/a", 0), ("", 0), (None, 0), ("12.5", "12.5"), ("$5", 0), ("1,000", 0)])
def test_numeric_or_zero(spark, text, value):
    assert one(spark, x.numeric_or_zero("t"), t=text) == Decimal(value)


def test_strict_cast_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, F.col("t").cast(x.MONEY), t="abc")


def test_guarded_ratio(spark):
    assert one(spark, x.guarded_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, x.guarded_ratio(F.lit(1), F.lit(4))) == 0.25


def test_decimal_product_type(spark):
    df = spark.range(1).select((F.lit(1).cast(x.MONEY) * F.lit(2).cast(x.MONEY)).alias("p"))
    assert df.schema["p"].dataType.simpleString() == "decimal(38,7)"


def test_section_suffix(spark):
    assert one(spark, x.section_suffix("r", "n"), r="P", n=7) == "P-07"
    assert one(spark, x.section_suffix("r", "n"), r="P", n=12) == "P-12"
    assert one(spark, x.section_suffix(F.lit(None).cast("string"), "n"), n=7) is None
    with pytest.raises(Exception, match="two digits: 100"):
        one(spark, x.section_suffix("r", "n"), r="P", n=100)


def test_first_of_month(spark):
    assert str(one(spark, x.first_of_month("d"), d="2020-02-29 13:00:00")) == "2020-02-01 00:00:00"


def test_maps(spark):
    assert one(spark, x.map_section_status("s"), s="bound mta") == "Live"
    assert one(spark, x.map_section_status("s"), s="?") is None
    assert one(spark, x.map_state("s"), s="NY") == "New York"
    assert one(spark, x.map_state("s"), s="DC") == "DC"
    assert len(fv.STATE_NAMES) == 50


def test_flags(spark):
    assert one(spark, x.flag_off(F.lit(None).cast("int"))) and not one(spark, x.flag_off(F.lit(1)))
    assert not one(spark, x.flag_on(F.lit(None).cast("boolean"))) and one(spark, x.flag_on(F.lit(True)))


def test_currency_rules(spark):
    assert one(spark, x.reporting_currency("c"), c="CAD") == "CAD"
    assert one(spark, x.reporting_currency("c"), c="JPY") == "USD"
    assert one(spark, x.reporting_currency(F.lit(None).cast("string"))) == "USD"
    rate = x.settlement_to_usd("c", "g", F.lit("0.5").cast(x.RATIO))
    assert one(spark, rate, c="EUR", g=2) == 1
    assert one(spark, rate, c="JPY", g=0) == 1
    assert one(spark, rate, c="JPY", g=2) == Decimal("0.5")


def test_required(spark):
    with pytest.raises(Exception, match="NULL in required column amount"):
        one(spark, x.required(F.lit(None).cast("int"), "amount"))


def test_hashes(spark):
    df = spark.createDataFrame([("a", None, Decimal("1.5"))], "s string, n string, d decimal(19,4)")
    assert df.select(joined_text(df, ["s", "n", "d"])).first()[0] == "a#NULL#1.5000"
    assert len(df.select(row_hash(df, df.columns)).first()[0]) == 32
    timed = df.select(F.lit("2020-01-02 03:04:05.678").cast("timestamp").alias("t"))
    assert timed.select(joined_text(timed, ["t"])).first()[0] == "2020-01-02T03:04:05.678+00:00"
    keys = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("NULL", "x"), ("-", "x")], "a string, b string")
    made = [r[0] for r in keys.select(hash_key(keys, ["a", "b"])).collect()]
    assert len(set(made)) == 5 and all(len(k) == 32 for k in made)


@pytest.mark.parametrize("product,focus,year,want", [
    (fv.FLOOD_PRODUCT, "x", 2015, "b"), (fv.WIND_PRODUCT, "x", 2017, "a"), (fv.WIND_PRODUCT, "x", 2018, "c"),
    ("Home", "x", 2018, "a"), ("Home", fv.EXCLUDED_TRIFOCUS, 2018, "old"), ("Home", None, 2018, "old"),
    (None, "x", 2018, "old")])
def test_binder_rule(spark, product, focus, year, want):
    row = spark.createDataFrame([(product, focus, year)], "ProductName string, TriFocus string, YearOfAccount int")
    assert row.select(binder_rule(*map(F.lit, ("old", "a", "b", "c")))).first()[0] == want


def test_binder_rule_without_general_binder(spark):
    row = spark.createDataFrame([(fv.WIND_PRODUCT, "x", 2017)], "ProductName string, TriFocus string, YearOfAccount int")
    none = F.lit(None).cast("string")
    assert row.select(binder_rule(F.lit("old"), none, none, F.lit("c"))).first()[0] == "c"


def test_trifocus_name(spark):
    def name(product, company=None, target=None, own=None):
        return one(spark, trifocus_name(*[F.lit(v).cast("string") for v in (product, company, target, own)]))
    assert name("UK HULL v5") == "UK Marine"
    builders = fv.BUILDERS_RISK_PRODUCT.replace("%", " 9")
    lloyd, inc = [p.replace("%", " ") for p in fv.BUILDERS_RISK_FOCUS]
    assert (name(builders, lloyd), name(builders, inc)) == ("BUSA Engineering", "BICI Engineering")
    assert name(builders, "other", None, "own") == "own"
    assert name("z", None, "target", "own") == "target"
