import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portfolio_ops import schemas as s
from portfolio_ops.functions import fixed_values as fv
from portfolio_ops.operators.contract import Contract, ContractViolation
from portfolio_ops.plans.claim_binder import claim_binder_pairs
from portfolio_ops.plans.cession import cession_multiplier
from portfolio_ops.plans.key_industry import key_industry
from portfolio_ops.plans.mapping_override import land_mapping_override, live_overrides
from portfolio_ops.session import shared_dir, stage
from portfolio_ops.sources.landing import json_paths, land_events, with_defaults, with_lineage, with_surrogate
from portfolio_ops.sources.registry import Registry, TableSource, quoted
from portfolio_ops.sources import snapshot
from portfolio_ops.sources.snapshot import Load, SnapshotTable, publish_together
from portfolio_ops.streaming.key_industry import key_industry_stream, load_batch

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_publish_append_replace(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), KV)
    assert table.read().count() == 0 and table.version() == 0
    first = table.publish(spark.createDataFrame([("a", 1)], KV))
    assert (first.version, first.rows_inserted) == (1, 1)
    assert table.publish(spark.createDataFrame([("b", 2), ("c", 3)], KV), "append").rows_inserted == 2
    assert rows(table.read()) == [("a", 1), ("b", 2), ("c", 3)]
    assert table.compact().rows_inserted == 3 and rows(table.read()) == [("a", 1), ("b", 2), ("c", 3)]
    # a table may be replaced by a query over itself
    table.publish(table.read().filter("v > 1"))
    assert rows(table.read()) == [("b", 2), ("c", 3)] and table.version() == 4


def test_failed_publish_leaves_the_previous_version(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), KV)
    table.publish(spark.createDataFrame([("a", 1)], KV))
    contract = Contract(("k",), {"PK": ("k",)})
    with pytest.raises(ContractViolation, match="NOT NULL k: 1"):
        table.publish(spark.createDataFrame([(None, 2)], KV), contract=contract)
    with pytest.raises(ContractViolation, match="PK: 1"):
        table.publish(spark.createDataFrame([("a", 2)], KV), "append", contract=contract)
    with pytest.raises(Exception, match="boom"):
        table.publish(spark.createDataFrame([("a", 2)], KV).withColumn("v", F.raise_error(F.lit("boom")).cast("long")))
    assert rows(table.read()) == [("a", 1)] and table.version() == 1
    with pytest.raises(ValueError, match="columns missing"):
        table.publish(spark.range(1).select(F.lit("x").alias("k")))


def test_publish_together(spark, tmp_path):
    a, b = (SnapshotTable(spark, str(tmp_path / n), KV) for n in "ab")
    df = spark.createDataFrame([("a", 1)], KV)
    assert [r.version for r in publish_together([Load(a, df), Load(b, df)])] == [1, 1]
    bad = df.withColumn("v", F.raise_error(F.lit("boom")).cast("long"))
    with pytest.raises(Exception, match="boom"):
        publish_together([Load(a, df), Load(b, bad)])
    assert a.version() == b.version() == 1  # nothing was switched


def test_one_log_switches_all_tables_or_none(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    a, b = (SnapshotTable(spark, str(tmp_path / n), KV, log) for n in "ab")
    first, second = spark.createDataFrame([("a", 1)], KV), spark.createDataFrame([("a", 2)], KV)
    publish_together([Load(a, first), Load(b, first)])
    writes = []
    create = spark.createDataFrame

    def fail_after_one(*args, **more):
        """A log write may succeed; another one would fail."""
        if len(args) > 1 and args[1] is snapshot.LOG_SCHEMA:
            writes.append(args[0])
            if len(writes) > 1:
                raise RuntimeError("lost between two switches")
        return create(*args, **more)
    monkeypatch.setattr(spark, "createDataFrame", fail_after_one)
    publish_together([Load(a, second), Load(b, second)])
    assert len(writes) == 1 and rows(a.read()) == rows(b.read()) == [("a", 2)]
    monkeypatch.undo()
    bad = Load(b, spark.createDataFrame([(None, 3)], KV), Contract(("k",)))
    with pytest.raises(ContractViolation):
        publish_together([Load(a, first), bad])
    assert rows(a.read()) == rows(b.read()) == [("a", 2)]


def test_many_appends_stay_small_and_vacuum_cleans(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshot, "COMPACT_FOLDERS", 4)
    table = SnapshotTable(spark, str(tmp_path / "t"), KV)
    for k in range(11):
        table.publish(spark.createDataFrame([(f"k{k}", k)], KV), "append",
                      contract=Contract(("k",), {"PK": ("k",)}), batch=f"b{k}")
    assert rows(table.read()) == sorted((f"k{k}", k) for k in range(11))
    assert table.history().agg(F.max(F.size("folders"))).first()[0] == 1
    assert len(table._folders()[1]) <= 5
    assert table.has_batch("b3") and not table.has_batch("b99")
    with pytest.raises(ContractViolation, match="PK: 1"):
        table.publish(spark.createDataFrame([("k2", 0)], KV), "append", contract=Contract((), {"PK": ("k",)}))
    kept = len(table._folders()[1])
    assert table.vacuum() > 0
    assert len(list((tmp_path / "t" / "data").iterdir())) == kept
    assert rows(table.read()) == sorted((f"k{k}", k) for k in range(11)) and table.vacuum() == 0


def test_registry(spark, tmp_path):
    spark.createDataFrame([("a", 1)], KV).write.parquet(str(tmp_path / "p"))
    names = Registry(spark, {"[Db].[Schema].[TBL:Odd.Table]": str(tmp_path / "p"),
                             "plain": TableSource(path=str(tmp_path / "p"), schema=KV)})
    assert rows(names.read_table("[db].[SCHEMA].[tbl:odd.table]")) == [("a", 1)]
    assert rows(names.read_table("plain")) == [("a", 1)]
    assert quoted("a.[b.c].d") == "`a`.`b.c`.`d`"
    spark.createDataFrame([("v", 1)], KV).createOrReplaceTempView("some_view")
    assert rows(names.read_table("some_view")) == [("v", 1)]


def test_stage_and_shared_dir(spark):
    df = stage(spark.createDataFrame([("a", 1)], KV))
    assert df.schema == KV and shared_dir(spark) in df.inputFiles()[0]


def test_json_paths(spark):
    docs = [('{"A":{"B":"x"}}', "x"), ('{"A":{"b":"x"}}', None), ('{"A":{"B":null}}', None), ("not json", None), (None, None)]
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(docs)], "i int, d string")
    got = [r["out"] for r in json_paths(df, "d", {"out": "$.A.B"}).orderBy("i").collect()]
    assert got == [want for _, want in docs]
    variant = df.filter("i < 3").withColumn("d", F.parse_json("d"))
    assert json_paths(variant, "d", {"out": "$.A.B"}).filter("out = 'x'").count() == 1


def test_landing_columns(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "k string, c string")
    filled = with_defaults(df, {"c": "dflt", "d": 7})
    assert rows(filled) == [("a", "dflt", 7), ("b", "x", 7)]
    lined = with_lineage(df, "p1", "src", "STG")
    assert {"created_at_ts", "created_by", "process_id", "source_name", "created_from"} <= set(lined.columns)
    assert with_surrogate(df, "id").select("id").distinct().count() == 2
    topic = spark.createDataFrame([(b"{}", dt.datetime(2024, 1, 1), 5, 1)], "value binary, timestamp timestamp, offset long, partition int")
    assert land_events(topic).columns == ["RECORD_CONTENT", "RECORD_KAFKA_NPTS", "RECORD_KAFKA_OFFSET", "RECORD_KAFKA_PARTITION"]


def test_cession(make):
    p = [("r", 2, -100, 10), ("r", 1, -1, 99), ("zero", 2, 0, 5), ("none", 2, -5, None), ("empty", 2, None, 4)]
    premium = make(s.PREMIUM, [dict(Reference=r, Period2=q, GPW=None if g is None else D(g),
                                    ICWP_F=None if c is None else D(c)) for r, q, g, c in p])
    marine = make(s.MARINE_PREMIUM, [dict(Reference="r", Period2=1, GrossWrittenPremium=D(4), CededPremiumToInternalFAC=D(1))])
    weather = make(s.WEATHER_PREMIUM, [])
    got = [(r[0], float(r[1])) for r in cession_multiplier(premium, marine, weather).collect()]
    assert sorted(got) == [("r", 0.1), ("r", 0.25)]


def test_claim_binder(make):
    exposure = make(s.CLAIM_EXPOSURE, [dict(SourceSystem=x, ClaimSourceId=c, BinderReference=b) for x, c, b in [
        ("ClaimCenter", "1", "B"), ("claimcenter", "1", "b "), ("CLAIMCENTER", "2", None), ("other", "1", "B"), ("claimcenter", "3", "B")]])
    claim = make(s.CLAIM_HEADER, [dict(SourceSystem="CLAIMCENTER", ClaimSourceId=c, PolicyNumber=p, IsRetired=r) for c, p, r in [
        ("1", "P1", None), ("1", "p1", 0), ("2", "P2", 0), ("3", "P3", 1)]])
    got = claim_binder_pairs(exposure, claim)
    assert [(r[0].lower(), r[1].lower().strip()) for r in got.collect()] == [("p1", "b")]
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()


DOC = '{"Result":{"Key_Industry":{"Code_Name":null,"Code_Str":%s,"Code_Type":"NAICS"}}}'


def rating(key, code='"111"', client="c"):
    return dict(BK_RATER_NAME="r", BK_VERSION="1", BK_RATING_ID=key, BK_CLIENT_SUPPLIED_ID=client, RECORD_CONTENT=DOC % code)


def test_key_industry(make):
    stored = make(s.KEY_INDUSTRY, [{k: v for k, v in rating("old").items() if k != "RECORD_CONTENT"}])
    batch = [rating("old"), rating("new"), rating("twice"), rating("twice"), rating("nullcode", "null"), rating("nullkey", client=None)]
    got = key_industry(make(s.RATING_INTERIM, batch), stored)
    assert sorted(r["BK_RATING_ID"] for r in got.collect()) == ["new", "nullkey", "twice", "twice"]
    assert got.columns == s.KEY_INDUSTRY.fieldNames() and got.first()["CODE_TYPE"] == "NAICS"


def test_mapping_override(make):
    records = make(s.MAPPING_OVERRIDE, [dict(CODE=c, IS_DELETED=d, CREATED_BY=b) for c, d, b in [
        ("a", True, None), ("b", False, "me"), ("c", None, None)]])
    defaults = {"CREATED_BY": "job", "CREATED_FROM": "topic", "SOURCE_NAME": "list"}
    got = {r["CODE"]: r for r in live_overrides(land_mapping_override(records, defaults)).collect()}
    assert set(got) == {"b", "c"} and got["b"]["CREATED_BY"] == "me"
    assert got["c"]["CREATED_BY"] == "job" and got["c"]["CREATED_AT"] is not None


def test_stream_equals_batch_and_replay_adds_nothing(spark, make, tmp_path):
    landing = str(tmp_path / "landing")
    target = SnapshotTable(spark, str(tmp_path / "table"), s.KEY_INDUSTRY)

    def drain():
        stream = spark.readStream.schema(s.RATING_INTERIM).parquet(landing)
        key_industry_stream(stream, target, str(tmp_path / "cp"), available_now=True).awaitTermination()
        return sorted(r["BK_RATING_ID"] for r in target.read().collect())
    make(s.RATING_INTERIM, [rating("a"), rating("b")]).coalesce(1).write.mode("append").parquet(landing)
    assert drain() == ["a", "b"]
    make(s.RATING_INTERIM, [rating("b"), rating("c")]).coalesce(1).write.mode("append").parquet(landing)
    assert drain() == ["a", "b", "c"] == drain()
    # the same batch id again, although its key would count as new (missing key part)
    replay = make(s.RATING_INTERIM, [rating("d", client=None)])
    load_batch(replay, target, "x-7")
    load_batch(replay, target, "x-7")
    assert sorted(r["BK_RATING_ID"] for r in target.read().collect()) == ["a", "b", "c", "d"]
