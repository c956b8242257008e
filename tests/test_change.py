import pytest
from pyspark.sql import functions as F

from portfolio_ops.functions.exprs import folded
from portfolio_ops.operators import change
from portfolio_ops.operators.change import (
    drop_superseded, fill_from_first, fill_from_group_max, insert_new, merge_by_hash, merge_snapshot)
from portfolio_ops.operators.contract import Contract, ContractViolation, ForeignKey, check_contract, enforce, quarantine
from portfolio_ops.operators.filters import changed_since, delete_where, high_water_mark, latest_period, stored_state
from portfolio_ops.operators.lookups import lookup, with_one_row
from portfolio_ops.operators.migrate import TableMigration, migrate, migrate_table, reparent

SCHEMA = "a string, b int, v string, h string, made string"
ROWS = [("same", 1, "x", "h1", "old"), ("changed", 1, "x", "h1", "old"), ("gone", 1, "x", "h1", "old"),
        ("nohash", 1, "x", None, "old"), (None, 1, "x", "h1", "old")]
NEW = [("same", 1, "y", "h1", "new"), ("changed", 1, "y", "h2", "new"), ("fresh", 1, "y", "h9", "new"),
       ("nohash", 1, "y", "h2", "new"), (None, 1, "y", "h2", "new"), (None, 1, "y", "h2", "new")]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge(spark):
    target, source = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    merged = merge_snapshot(target, source, ["a", "b"], "h", ["v"])
    want = [("same", 1, "x", "h1", "old"), ("changed", 1, "y", "h2", "old"), ("fresh", 1, "y", "h9", "new"),
            ("nohash", 1, "x", None, "old"), (None, 1, "y", "h2", "new"), (None, 1, "y", "h2", "new")]
    assert rows(merged) == sorted(want, key=repr)
    kept = merge_snapshot(target, source, ["a", "b"], "h", ["v"], delete_missing=False)
    assert kept.count() == len(want) + 2


def test_merge_twice_is_merge_once(spark):
    complete = [r for r in NEW if r[0]]
    target, source = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(complete, SCHEMA)
    once = merge_snapshot(target, source, ["a", "b"], "h", ["v"])
    assert rows(once) == rows(merge_snapshot(once, source, ["a", "b"], "h", ["v"]))


def test_merge_refuses_repeated_source_keys(spark):
    source = spark.createDataFrame([NEW[0], NEW[0]], SCHEMA)
    with pytest.raises(Exception, match="repeated source key: same, 1"):
        merge_snapshot(spark.createDataFrame(ROWS, SCHEMA), source, ["a", "b"], "h", ["v"]).collect()


@pytest.mark.parametrize("delete_missing", [True, False])
@pytest.mark.parametrize("share", [0, 1, 50, 100])
def test_merge_by_hash_is_the_merge(spark, share, delete_missing):
    """Of 200 keys ``share`` percent change; keys are new, gone, incomplete and, stored, repeated."""
    stored = [(f"k{i}", 1, "x", f"h{i}", "old") for i in range(200)] + ROWS + [
        ("k3", 1, "z", "other", "old"), ("k4", 1, "z", None, "old")]
    fresh = [(f"k{i}", 1, "y", f"h{i}" if i % 100 >= share else f"n{i}", "new") for i in range(3, 205)] + NEW
    target, source = spark.createDataFrame(stored, SCHEMA), spark.createDataFrame(fresh, SCHEMA)
    sides = (target, source, ["a", "b"], "h", ["v"], delete_missing)
    assert rows(merge_by_hash(*sides)) == rows(merge_snapshot(*sides))


def test_merge_by_hash_edges(spark):
    source = spark.createDataFrame([NEW[0], NEW[0]], SCHEMA)
    target, empty = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame([], SCHEMA)
    with pytest.raises(Exception, match="repeated source key: same, 1"):
        merge_by_hash(target, source, ["a", "b"], "h", ["v"]).collect()
    assert rows(merge_by_hash(target, empty, ["a", "b"], "h", ["v"])) == []
    assert rows(merge_by_hash(empty, target, ["a", "b"], "h", ["v"])) == rows(target)
    with pytest.raises(ValueError, match="lacks target columns"):
        merge_by_hash(target, source.drop("made"), ["a", "b"], "h", ["v"])


def test_few_changes_shuffle_no_wide_row(spark):
    from portfolio_ops.session import stage
    wide = spark.range(20_000).selectExpr("id AS a", "md5(cast(id AS string)) AS v", "id AS h")
    target, source = stage(wide), stage(wide.withColumn("h", F.when(F.col("a") % 5000 == 0, -1).otherwise(F.col("h"))))
    merged = merge_by_hash(target, source, ["a"], "h", ["v"])
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_distinct_rows_is_distinct_text(spark):
    from portfolio_ops.operators.dedupe import distinct_rows, distinct_text
    data = [("A ", 1, 0.0), ("a", 1, -0.0), (None, 1, None), (None, 1, None), ("b", None, 2.0), (None, None, None),
            ("x", None, None), (None, 2, None)] + [("Hot", 5, 1.5), ("hot ", 5, 1.5)] * 50
    df = spark.createDataFrame(data, "t string, n int, d double")
    for part in (df, df.limit(0)):
        assert rows(distinct_rows(part, df.columns, folded)) == rows(distinct_text(part, df.columns, folded))
    # one digest for all rows: the columns decide
    clash = df.select(F.lit(None).cast("string").alias("p"), "t")
    both = clash.unionByName(clash.select(F.col("t").alias("p"), F.lit(None).cast("string").alias("t")))
    assert rows(distinct_rows(both, ["p", "t"], folded)) == rows(distinct_text(both, ["p", "t"], folded))


def test_insert_new_keeps_copies_and_null_keys(spark):
    target = spark.createDataFrame([("k", 1), (None, 1)], "k string, v int")
    source = spark.createDataFrame([("k", 2), ("n", 3), ("n", 4), (None, 5)], "k string, v int")
    assert rows(insert_new(target, source, ["k"])) == sorted([("n", 3), ("n", 4), (None, 5)], key=repr)
    one = insert_new(target, source, ["k"], dedupe_within_batch=[F.col("v").asc()])
    assert rows(one) == sorted([("n", 3), (None, 5)], key=repr)


def test_drop_superseded_ignores_case(spark):
    df = spark.createDataFrame([("r1", "FDR"), ("R1 ", "pro"), ("r2", "fdr"), ("r3", "other"), ("r3", "pro")], "ref string, s string")
    got = drop_superseded(df, df, "ref", "s", [("FDR", "Pro")], fold=folded)
    assert rows(got) == [("R1 ", "pro"), ("r2", "fdr"), ("r3", "other"), ("r3", "pro")]


def test_fills(spark):
    df = spark.createDataFrame([("p", 1, 10, "USD"), ("p", 2, None, "EUR"), ("q", 2, None, "EUR"), ("r", 1, None, None),
                                ("r", 2, None, "GBP"), (None, 2, None, "X")], "g string, n int, lim int, ccy string")
    got = fill_from_first(df, "g", F.col("n") == 1, "lim", ["lim", "ccy"])
    assert rows(got) == sorted([("p", 1, 10, "USD"), ("p", 2, 10, "USD"), ("q", 2, None, "EUR"), ("r", 1, None, None),
                                ("r", 2, None, None), (None, 2, None, "X")], key=repr)
    got = fill_from_group_max(df, "g", "ccy")
    assert ("r", 1, None, "GBP") in rows(got) and len(rows(got)) == 6


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert rows(delete_where(df, F.col("v") != 1)) == sorted([(1,), (None,)], key=repr)


def test_marks_and_periods(spark):
    df = spark.createDataFrame([("2020-01-01", None), ("2019-01-01", "2021-01-01")], "c string, m string").select(
        F.col("c").cast("timestamp_ntz"), F.col("m").cast("timestamp_ntz"))
    mark = high_water_mark(df, "c", "m")
    assert str(mark) == "2021-01-01 00:00:00"
    assert str(stored_state(df.limit(0), "c", "m")[0]) == "1900-01-01 00:00:00"
    assert stored_state(df.limit(0), "c", "m")[1] and not stored_state(df, "c", "m")[1]
    assert df.filter(changed_since(mark, F.col("c"), F.col("m"))).count() == 1  # equal counts, NULL does not
    periods = spark.createDataFrame([(1, 202001), (2, 202002), (3, 202002)], "id int, p int")
    assert rows(latest_period(periods, "p")) == [(2, 202002), (3, 202002)]


def test_lookup_sizes(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    table = spark.createDataFrame([(1, "one")], "code int, name string")
    got = lookup(df, table, F.col("k"), F.col("code"), {"name": F.col("name")})
    assert rows(got) == sorted([(1, "one"), (2, None)], key=repr)
    assert "ResolvedHint" not in got._jdf.queryExecution().analyzed().toString()


def test_one_row_table(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    run = spark.createDataFrame([("r1",)], "id string")
    assert rows(with_one_row(df, run, ["id"])) == [(1, "r1"), (2, "r1")]
    with pytest.raises(Exception, match="no row to take id"):
        with_one_row(df, run.limit(0), ["id"]).collect()
    with pytest.raises(Exception):
        with_one_row(df, run.union(run), ["id"]).collect()


def test_contract(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 3), ("long", 1)], "k string, p int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    contract = Contract(("p",), {"PK": ("k",)}, {"FK": ForeignKey(("p",), "parent", ("id",))}, {"k": 3})
    found = {r["rule"]: r["violations"] for r in check_contract(df, contract, {"parent": parent}).collect()}
    assert found == {"NOT NULL p": 1, "LENGTH k": 1, "PK": 1, "FK": 1}
    with pytest.raises(ContractViolation, match="PK: 1"):
        enforce(df, contract, {"parent": parent})
    good, bad = quarantine(df, ["k", "p"])
    assert good.count() == 3 and bad.count() == 2


def test_migration(spark):
    df = spark.createDataFrame([("n", 1)], "A_NAME string, X int")
    step = TableMigration("T_RAW", {"A_NAME": "A_NME"}, {"PROCESS_ID": "decimal(38,0)"}, ("X",))
    out = migrate({"T": df, "U": df}, {"T": step}, {"T": {"PROCESS_ID": F.lit(5)}})
    assert out["T_RAW"].columns == ["A_NME", "PROCESS_ID"] and out["U"].columns == df.columns
    with pytest.raises(ValueError, match="MISSING"):
        migrate({"T": df}, {"MISSING": step}, {})
    with pytest.raises(ValueError, match="no fill value"):
        migrate_table(df, step, {})
    sat = spark.createDataFrame([("l1", 5)], "LNK string, v int")
    link = spark.createDataFrame([("l1", "h1"), ("l1", "h1")], "LNK string, HUB string")
    assert rows(reparent(sat, link, "LNK", "HUB")) == [("l1", 5, "h1")]


@pytest.mark.parametrize("changed, joins_all", [(5, False), (30, True)])
def test_many_touched_keys_are_merged_in_one_join(spark, monkeypatch, changed, joins_all):
    seen = []
    monkeypatch.setattr(change, "merge_snapshot", lambda *a: (seen.append(1), merge_snapshot(*a))[1])
    target = spark.createDataFrame([(f"k{i}", 1, "x", f"h{i}", "old") for i in range(100)], SCHEMA)
    source = spark.createDataFrame([(f"k{i}", 1, "y", f"n{i}" if i < changed else f"h{i}", "new") for i in range(100)], SCHEMA)
    merged = merge_by_hash(target, source, ["a", "b"], "h", ["v"])
    assert bool(seen) == joins_all
    assert merged.filter("v = 'y' and made = 'old'").count() == changed and merged.count() == 100
