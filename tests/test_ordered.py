import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from portfolio_ops.operators.dedupe import first_per_key, keep_max_key, latest_per_key
from portfolio_ops.operators.ordered import (
    Ordered, balance_columns, large_groups, ordered_groups, plain, segment_count, segmented)
from portfolio_ops.operators.ranking import global_dense_rank


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows in one group, a group of missing keys, and missing values."""
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rnd.randrange(40)}"
        data.append((key, rnd.randrange(5), rnd.choice([None, rnd.randrange(100)]), i,
                     None if rnd.random() < 0.2 else Decimal(rnd.randrange(-50, 50))))
    return spark.createDataFrame(data, "k string, g int, t int, id int, v decimal(19,4)").repartition(7)


def spec():
    return Ordered(["k", "g"], [F.col("t").desc_nulls_first(), F.col("id").asc()],
                   position="pos", group_size="size", running={"run": "v"},
                   lags={"prev": "v", "prev_id": "id"}, leads={"next": "v"}, missing={"prev_id": -1})


def collect(df, *names):
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


NAMES = ["k", "g", "t", "id", "v", "pos", "size", "run", "prev", "prev_id", "next"]


def test_segmented_equals_plain(rows):
    assert collect(segmented(rows, spec()), *NAMES) == collect(plain(rows, spec()), *NAMES)


def test_groups_really_are_cut(spark, rows):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small data would be coalesced to one range
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        only = Ordered(["k"], [F.col("id").asc()], position="pos", running={"run": "v"},
                       lags={"prev": "v"}, leads={"next": "v"}, group_size="size")
        names = ["k", "id", "pos", "run", "prev", "next", "size"]
        ranges = rows.repartitionByRange("k", "id").withColumn("p", F.spark_partition_id())
        assert ranges.filter("k = 'hot'").select("p").distinct().count() > 3
        assert collect(segmented(rows, only), *names) == collect(plain(rows, only), *names)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_large_groups_take_the_segmented_way(rows):
    large = large_groups(rows, ["k"], 500, segment_rows=1)
    assert [r["k"] for r in large.keys.collect()] == ["hot"]
    hot = rows.filter("k = 'hot'")
    assert large.segments >= 2 * -(-hot.count() // 500)
    ranges = hot.repartitionByRange(large.segments, "k", "id").withColumn("p", F.spark_partition_id())
    assert ranges.groupBy("p").count().agg(F.max("count")).first()[0] <= 500
    assert large_groups(rows, ["k"], 5000) is None
    one = Ordered(["k"], [F.col("id").asc()], position="pos")
    got = ordered_groups(rows, one, group_rows=500)
    assert collect(got, "k", "id", "pos") == collect(plain(rows, one), "k", "id", "pos")
    assert got.count() == rows.count()


@pytest.mark.parametrize("rows, group_rows, want", [
    (10_000, 5, 2), (1_000_000, 5, 200), (8_000_001, 4_000_000, 5), (1, 5, 1)])
def test_segments_follow_from_all_rows(rows, group_rows, want):
    assert segment_count(rows, group_rows) == want


@pytest.mark.parametrize("rows, group_rows, want", [
    (20_000_000, 5, 200), (200_000_000, 300, 400), (100_000_000, 4_000_000, 50)])
def test_segments_of_large_tables_grow_before_their_number_does(rows, group_rows, want):
    assert segment_count(rows, group_rows) == want


def test_many_groups_just_too_large_share_segments(spark):
    """5,000 groups of six rows with a limit of five fill a few range partitions, not thousands."""
    df = spark.range(30_000).selectExpr("id % 5000 as k", "id as t", "id % 7 as v")
    large = large_groups(df, ["k"], 5)
    assert large.keys.count() == 5000 and large.segments == 6
    one = Ordered(["k"], [F.col("t").asc()], position="pos", running={"run": "v"}, lags={"prev": "v"})
    got = ordered_groups(df, one, group_rows=5)
    assert collect(got, "k", "t", "pos", "run", "prev") == collect(plain(df, one), "k", "t", "pos", "run", "prev")


@pytest.mark.parametrize("hot", [0, 900])
def test_large_groups_are_looked_for_by_buckets(spark, tmp_path, hot):
    """Keys are counted only in large buckets, so a table of small groups shuffles no keys."""
    rows = spark.range(3000).selectExpr(f"if(id < {hot}, 'hot', cast(id as string)) as k", "id as t")
    asked = []

    class Seen:
        def __init__(self, df):
            self.df = df

        def __getattr__(self, name):
            return getattr(self.df, name)

        def groupBy(self, *keys):
            asked.append([str(k) for k in keys])
            return self.df.groupBy(*keys)
    large = large_groups(Seen(rows), ["k"], 500)
    assert (large is None) == (hot == 0) and ["k"] not in asked and len(asked) == 1
    if hot:
        assert [r["k"] for r in large.keys.collect()] == ["hot"]


def test_small_tables_need_no_grouped_count(spark, monkeypatch):
    import portfolio_ops.operators.ordered as ordered
    monkeypatch.setattr(ordered, "stage", lambda *a: pytest.fail("nothing is staged"))
    df = spark.range(100).selectExpr("id % 3 as k", "id as t")
    assert large_groups(df, ["k"], 100) is None and large_groups(df, ["k"], 99) is None


def test_balance_equals_lag_form(rows):
    filled = rows.fillna({"v": 0}).withColumn("inflow", F.col("id") % 7)
    w = W.partitionBy("k").orderBy("id")
    direct = (filled.withColumn("f", F.lag("v", 1, 0).over(w) + F.col("inflow"))
              .withColumn("b", F.sum("f").over(w.rowsBetween(W.unboundedPreceding, 0))))
    add, running = balance_columns({"b": ("v", F.col("inflow"))})
    short = plain(filled.withColumns(add), Ordered(["k"], [F.col("id").asc()], running=running))
    short = short.withColumn("b", F.col("_run_b") - F.col("v"))
    as_text = F.col("b").cast("decimal(30,4)").alias("b")
    assert collect(direct.select("id", as_text), "id", "b") == collect(short.select("id", as_text), "id", "b")


@pytest.mark.parametrize("parts", [1, 4, 37])
def test_dense_rank_equals_window(spark, rows, parts):
    want = rows.withColumn("r", F.dense_rank().over(W.orderBy(F.col("k").asc_nulls_last(),
                                                             F.col("t").asc_nulls_last())))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = global_dense_rank(rows.repartition(parts), ["k", "t"], "r")
        assert collect(got, "id", "r") == collect(want, "id", "r")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_dense_rank_uses_no_single_partition_over_rows(rows):
    plan = global_dense_rank(rows, ["k"], "r")._jdf.queryExecution().toString()
    # the one unpartitioned window runs over per-partition counts only
    assert plan.split("== Physical Plan ==")[1].count("Exchange SinglePartition") == 1


def test_latest_per_key_null_time_is_newest(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", None, 2), ("b", 3, 4), ("b", 3, 5)], "k string, t int, id int")
    assert collect(latest_per_key(df, ["k"], ["t", "id"]), "k", "id") == [("a", 2), ("b", 5)]


def test_first_per_key_limits_groups_before_the_shuffle(rows):
    df = first_per_key(rows, ["k"], [F.col("id").asc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert df.count() == rows.select("k").distinct().count()


def test_keep_max_key(spark):
    df = spark.createDataFrame([("r", "9"), ("r", "10"), ("r", None), (None, "1"), (None, "2")], "ref string, k string")
    assert collect(keep_max_key(df, "ref", "k"), "ref", "k") == sorted(
        [("r", "9"), ("r", None), (None, "1"), (None, "2")], key=repr)  # text order: '9' > '10'


def test_rows_are_not_moved_to_meet_the_carried_values(spark, rows):
    """Only groups that a bound cuts carry values across, at most one per bound: those are broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = segmented(rows, spec())._jdf.queryExecution().toString().partition("== Physical Plan ==")[2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
