import datetime as dt
import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from portfolio_ops.operators.history import BUCKET, Columns, History, TwoPartSatellite, restitch, without_time
from portfolio_ops.operators.vault import load_satellite

SCHEMA = ("k string, a string, b int, SRC string, LOAD_DATETIME timestamp_ntz, HASH_DIFF string, "
          "END_DATETIME timestamp_ntz, IS_CURRENT_FLAG boolean")
NAMES = Columns("k", ["a", "b"])
SHOWN = ["k", "a", "b", "SRC", "LOAD_DATETIME", "END_DATETIME", "IS_CURRENT_FLAG"]


def frame(spark, rows):
    return spark.createDataFrame([(k, a, b, "s", None if d is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=d),
                                   None, None, None) for k, a, b, d in rows], SCHEMA)


def empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    return History(df, df.drop("END_DATETIME", "IS_CURRENT_FLAG"))


def shown(df):
    return sorted(map(tuple, df.select(*SHOWN).collect()), key=repr)


def case_rows(n=60, seed=1):
    rnd = random.Random(seed)
    return [(rnd.choice(["hot", "hot", "k1", "k2", None]), rnd.choice(["x", "y", None]), rnd.choice([1, None]),
             rnd.randrange(20)) for _ in range(n)]


def sorted_load(spark, rows):
    keyed = [r for r in rows if r[0] is not None]
    return shown(load_satellite(empty(spark).versions, frame(spark, keyed), "k", ["a", "b"]))


def test_every_order_of_batches_gives_the_sorted_load(spark):
    parts = [[("k", "a", 1, 1), ("k", "a", 1, 3), ("o", "q", 1, 2)], [("k", "b", 1, 2), ("k", "b", 1, 5)],
             [("k", "a", 1, 4), ("k", "c", None, 0)]]
    want = sorted_load(spark, sum(parts, []))
    for order in itertools.permutations(parts):
        made = empty(spark)
        for part in order:
            made = restitch(made, frame(spark, part), NAMES)
        assert shown(made.versions) == want


@pytest.mark.parametrize("group_rows", [1000, 4])
def test_random_batches(spark, group_rows):
    rows = case_rows()
    made = empty(spark)
    for k in range(0, len(rows), 20):
        made = restitch(made, frame(spark, rows[k:k + 20]), NAMES, group_rows)
    got = [r for r in shown(made.versions) if r[0] is not None]
    assert got == sorted_load(spark, rows)
    again = restitch(made, frame(spark, rows[:20]), NAMES)
    assert shown(again.versions) == shown(made.versions)        # a replay changes nothing
    assert again.confirmed.count() == made.confirmed.count()


def test_rows_without_time_are_set_aside(spark):
    batch = frame(spark, [("k", "a", 1, None), ("k", "a", 1, 1)])
    assert without_time(batch, NAMES).count() == 1
    assert restitch(empty(spark), batch, NAMES).versions.count() == 1


def files(base):
    out = {}
    for folder, _, names in os.walk(base):
        for n in names:
            if n.endswith(".parquet"):
                path = os.path.join(folder, n)
                out[path] = os.stat(path).st_mtime_ns
    return out


def table(spark, folder, buckets=4):
    return TwoPartSatellite(spark, str(folder), spark.createDataFrame([], SCHEMA).schema, NAMES, buckets)


def test_two_parts_equal_one_sorted_load(spark, tmp_path):
    rows = [r for r in case_rows(80, 5) if r[0]]
    own = table(spark, tmp_path / "sat")
    assert own.read().count() == 0
    for k in range(0, 80, 25):
        own.load(frame(spark, rows[k:k + 25]))
    assert shown(own.read()) == sorted_load(spark, rows)
    assert shown(own.read_current()) == [r for r in sorted_load(spark, rows) if r[-1]]
    before = shown(own.read())
    own.load(frame(spark, rows[50:]))
    assert shown(own.read()) == before


def test_untouched_buckets_and_closed_files_stay(spark, tmp_path):
    keys = [f"k{k}" for k in range(40)]
    own = table(spark, tmp_path / "sat", buckets=8)
    own.load(frame(spark, [(k, "a", 1, 1) for k in keys]))
    own.load(frame(spark, [(k, "b", 1, 2) for k in keys]))
    before = files(tmp_path / "sat" / "versions")
    own.load(frame(spark, [("k3", "c", 1, 3)]))
    after = files(tmp_path / "sat" / "versions")
    bucket = frame(spark, [("k3", "c", 1, 3)]).select(own._bucket().alias("n")).first()["n"]
    gone = set(before) - set(after)
    assert gone and all(f"is_current=true/{BUCKET}={bucket}/" in p for p in gone)      # closed files are only added
    assert all(before[p] == after[p] for p in set(before) & set(after))
    assert own.read().count() == 81
    own.load(frame(spark, [("k3", "z", 1, 0)]))       # late: its bucket alone is written anew
    last = files(tmp_path / "sat" / "versions")
    assert all(f"{BUCKET}={bucket}/" in p for p in set(after) - set(last))
    assert own.read().filter("k = 'k3'").count() == 4


def test_a_load_repeated_after_its_first_write_gives_the_same(spark, tmp_path, monkeypatch):
    own = table(spark, tmp_path / "sat")
    own.load(frame(spark, [("k", "a", 1, 1), ("o", "a", 1, 1)]))
    batch = frame(spark, [("k", "b", 1, 2), ("k", "a", 1, 4)])
    write = TwoPartSatellite._write

    def failing(self, df, folder, parts, mode):
        if mode == "overwrite":
            raise RuntimeError("lost")
        write(self, df, folder, parts, mode)
    monkeypatch.setattr(TwoPartSatellite, "_write", failing)
    with pytest.raises(RuntimeError):
        own.load(batch)
    monkeypatch.setattr(TwoPartSatellite, "_write", write)
    own.load(batch)
    assert shown(own.read()) == sorted_load(spark, [("k", "a", 1, 1), ("o", "a", 1, 1), ("k", "b", 1, 2), ("k", "a", 1, 4)])


def test_current_part_is_pruned(spark, tmp_path):
    own = table(spark, tmp_path / "sat")
    own.load(frame(spark, [("k", "a", 1, 1), ("k", "b", 1, 2)]))
    plan = own.read_current().filter(F.col("k") == "k")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan
