"""What a job leaves on disk while it runs: its staged and published rows, no shuffle files of earlier statements."""

import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from portfolio_ops.operators.contract import Contract, check_contract, enforce
from portfolio_ops.operators.dedupe import keep_max_key, newest_keys
from portfolio_ops.operators.ordered import large_groups
from portfolio_ops.session import RELEASE, shuffles_released, stage
from portfolio_ops.sources.snapshot import SnapshotTable

DAY = datetime.datetime(1996, 5, 1)
TABLES = {
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                 [(o, o % 5, o % 3, n, 1.0 + n, 10.0 * n, 0.01 * n, 0.02, "NAR"[(o + n) % 3], "FO"[o % 2], DAY)
                  for o in range(40) for n in range(1, 8)]),
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
               "o_orderpriority string",
               [(o, o % 7, "OFP"[o % 3], 100.0 + o, DAY, ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")[o % 4]) for o in range(40)]),
    "customer": ("c_custkey long, c_mktsegment string", [(c, "BUILDING") for c in range(7)]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(s, f"S{s}", s) for s in range(3)]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(n, f"N{n}", n % 5) for n in range(25)]),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def shuffle_blocks(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


class Left:
    """New shuffle files since the start; deleting them may take a moment."""

    def __init__(self, spark):
        self.spark, self.before = spark, shuffle_blocks(spark)

    def files(self):
        for _ in range(50):
            left = shuffle_blocks(self.spark) - self.before
            if not left:
                break
            time.sleep(0.1)
        return left


def grouped(spark):
    return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))


def test_staged_rows_are_all_that_stays(spark):
    left = Left(spark)
    staged = stage(grouped(spark))
    assert not left.files()
    assert sorted(r.n for r in staged.collect()) == [142] + [143] * 6
    assert all(f.endswith(".zstd.parquet") for f in staged.inputFiles())


def test_the_setting_is_put_back(spark):
    was = spark.conf.get(RELEASE)
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        assert spark.conf.get(RELEASE) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(RELEASE) == was


def test_published_rows_are_all_that_stays(spark, tmp_path):
    rows, left = grouped(spark), Left(spark)
    table = SnapshotTable(spark, str(tmp_path / "t"), rows.schema)
    table.publish(rows, contract=Contract(("k",), {"PK": ("k",)}))
    assert not left.files()
    assert all(f.endswith(".zstd.parquet") for f in table.read().inputFiles())
    left = Left(spark)
    check_contract(rows, Contract(("k",), {"PK": ("k",)})).collect()
    assert left.files()         # the helper sees shuffle files
    left = Left(spark)
    enforce(rows, Contract(("k",), {"PK": ("k",)}))
    assert large_groups(grouped(spark), ["k"], 3) is None
    assert not left.files()


def test_what_finds_the_newest_key_is_gone_when_rows_move(spark):
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), (None, "1"), ("c", None)], "r string, k string")
    left = Left(spark)
    kept = keep_max_key(rows, "r", "k", newest=stage(newest_keys(rows, "r", "k"), "newest"))
    assert not left.files()
    assert any("newest-" in f for f in kept.inputFiles())
    assert sorted(map(tuple, kept.collect()), key=repr) == [("a", "2"), ("b", "1"), ("c", None), (None, "1")]


@pytest.mark.parametrize("name", ["vault_load_whole", "vault_migration_whole", "claim_movement_ledger_segmented",
                                  "homeowners_section", "homeowners_transaction", "ledger_merge"])
def test_shuffles_go_with_their_statement(spark, folder, name):
    left, kept = Left(spark), f"{spark.conf.get('spark.checkpoint.dir')}/staged"
    earlier = set(os.listdir(kept)) if os.path.isdir(kept) else set()
    result = entry.queries()[name](spark, folder)
    assert not left.files()
    assert result.count() > 0
    if name.startswith("vault"):        # tables are written one after another, the result only reads them
        assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
    if name.startswith("homeowners"):
        staged = set(os.listdir(kept)) - earlier
        assert any(n.startswith("hits-") for n in staged) and any(n.startswith("newest-") for n in staged)
