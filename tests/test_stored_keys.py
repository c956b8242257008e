import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portfolio_ops.operators.change import not_stored
from portfolio_ops.operators.stored_keys import StoredKeys


@pytest.fixture
def keys(spark, tmp_path):
    def build(**more):
        return StoredKeys(spark, f"keys_{uuid.uuid4().hex}", str(tmp_path / "keys"), ["a", "b"], buckets=8, **more)
    return build


def rows(spark, numbers, shift=0):
    return spark.createDataFrame([(f"k{n}", n + shift if n % 5 else None, "x") for n in numbers],
                                 "a string, b int, other string")


@pytest.mark.parametrize("pruned_below", [1000, 3])
def test_equals_the_join_with_the_whole_table(spark, keys, pruned_below):
    stored, batch = rows(spark, range(30)), rows(spark, [*range(20, 50), 31, 31])
    own = keys(pruned_below=pruned_below)
    own.add(stored)
    want = not_stored(batch, stored, ["a", "b"])
    assert sorted(map(str, own.new_rows(batch).collect())) == sorted(map(str, want.collect()))
    own.add(stored)                                        # again: no answer changes
    assert own.new_rows(batch).count() == want.count()
    own.add(batch)
    left = own.new_rows(batch)
    assert left.filter("b is not null").count() == 0 and left.count() == batch.filter("b is null").count()


def test_stored_side_has_no_exchange_and_only_its_buckets_are_read(spark, keys):
    own = keys()
    own.add(rows(spark, range(1, 200)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = own.new_rows(rows(spark, [3]))
        plan = small._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 8" in plan
        large = keys(pruned_below=0).new_rows(rows(spark, range(300)))
        plan = large._jdf.queryExecution().executedPlan().toString()
        stored = plan[plan.index("FileScan"):] if plan.index("FileScan") else plan
        above = plan[:plan.index("FileScan")].splitlines()[-4:]
        assert plan.count("Exchange") == 1 and not any("Exchange" in line for line in above), plan
        assert "Bucketed: true" in stored
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keys_outlive_the_catalogue(spark, tmp_path):
    path = str(tmp_path / "keys")
    StoredKeys(spark, "keys_once", path, ["a", "b"]).add(rows(spark, [1, 2]))
    again = StoredKeys(spark, "keys_again", path, ["a", "b"])
    assert [r["a"] for r in again.new_rows(rows(spark, [1, 2, 3])).collect()] == ["k3"]


def test_a_batch_lost_before_its_keys_is_made_good(spark, keys, tmp_path, monkeypatch):
    from portfolio_ops.functions import fixed_values as fv
    from portfolio_ops.schemas import KEY_INDUSTRY
    from portfolio_ops.sources.snapshot import SnapshotTable
    from portfolio_ops.streaming import key_industry as stream

    facts = spark.range(3).select(*[
        (F.concat(F.lit(f.name), "id") if isinstance(f.dataType, T.StringType)
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in KEY_INDUSTRY.fields])
    monkeypatch.setattr(stream, "extract_key_industry", lambda df: df)
    target = SnapshotTable(spark, str(tmp_path / "table"), KEY_INDUSTRY)
    own = StoredKeys(spark, f"keys_{uuid.uuid4().hex}", str(tmp_path / "industry"), fv.KEY_INDUSTRY_KEYS)
    add = own.add
    own.add = lambda rows: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        stream.load_batch(facts, target, "q-0", own)
    own.add = add
    stream.load_batch(facts, target, "q-0", own)
    stream.load_batch(facts, target, "q-1", own)
    assert target.read().count() == 3
