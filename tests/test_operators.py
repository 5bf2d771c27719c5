"""Keyset scans, envelopes, as-of lookups and applied changes on small tables."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tideline.operators import asof, changes, envelope, keyset, projection
from tideline.plans.snapshot import SnapshotPlan, warehouse_columns
from tideline.types import mssql, mysql, postgres
from tideline.types.kind import UnknownType

KEYS = ["i", "b", "t"]


def scan_table(spark):
    rows = [(i, b, t, f"{i}{b}{t}") for i, b, t in [(1, 0, "a"), (29, 0, "a"), (29, 0, "b"), (29, 1, "a"), (88, 0, "x"), (88, 1, "a"), (88, 1, "z")] + [(100 + k, k % 2, "q") for k in range(18)]]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, "i int, b int, t string, v string"), sorted(rows)


@pytest.mark.parametrize("size", [1, 2, 5, 6, 24, 25, 26])
def test_pages_do_not_depend_on_their_size(spark, size):
    df, want = scan_table(spark)
    df = df.coalesce(1).cache()
    got = [tuple(r) for p in keyset.pages(df, KEYS, size) for r in p]
    assert got == want


def test_ranges(spark):
    df, want = scan_table(spark)
    got = df.where(keyset.between(KEYS, (29, 0, "b"), (88, 1, "a"))).collect()
    assert sorted(map(tuple, got)) == [r for r in want if (29, 0, "b") <= r[:3] <= (88, 1, "a")]
    assert keyset.fetch_bounds(df, KEYS) == (want[0][:3], want[-1][:3])
    with pytest.raises(keyset.EmptyTable):
        keyset.fetch_bounds(df.where("false"), KEYS)
    plan = df.where(keyset.after(KEYS, (29, 0, "b"), False))._jdf.queryExecution().optimizedPlan().toString()
    assert "i#" in plan


def test_first_bound_reaches_the_scan(spark, tmp_path):
    df, _ = scan_table(spark)
    df.write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = spark.read.parquet(str(tmp_path / "t")).where(keyset.between(KEYS, (29, 0, "b"), (88, 1, "a"))).select("v")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(i,29)" in text and "LessThanOrEqual(i,88)" in text and "Exchange" not in text


def test_overrides():
    assert keyset.overrides(["a", "b"], ["int", "text"], "5,x") == (5, "x")
    assert keyset.overrides(["a"], ["text"], ["x,y"]) == ("x,y",)
    assert keyset.overrides(["a"], ["int"], None) is None
    for kind, text in (("tinyint", "128"), ("mediumint", "8388608"), ("year", "1900"), ("year", "2156"), ("int", "x"), ("blob", "x"), ("boolean", "maybe")):
        with pytest.raises(ValueError):
            keyset.parse_override(kind, text)
    assert keyset.parse_override("year", "2155") == 2155 and keyset.parse_override("boolean", "1") is True
    with pytest.raises(ValueError):
        keyset.overrides(["a", "b"], ["int", "int"], "1")


def test_column_choice():
    choice = projection.ColumnChoice
    assert choice(excluded=("b",)).of(["a", "b", "c"], ["a"]) == ["a", "c"]
    assert choice(included=("c", "a")).of(["a", "b", "c"], ["a"]) == ["a", "c"]
    for bad in (lambda: choice(excluded=("a",)).of(["a"], ["a"]), lambda: choice(included=("b",)).of(["a", "b"], ["a"]), lambda: choice(("a",), ("b",)), lambda: choice(included=("z", "a")).of(["a"], ["a"])):
        with pytest.raises(projection.ColumnError):
            bad()


def test_noise(spark):
    said = ["BEGIN", "COMMIT", "BEGIN;", "SAVEPOINT x", "flush relay logs", " # Dummy event x", "ALTER TABLE a ADD b INT", "INSERT INTO mysql.rds_heartbeat2(id) values (1) ON DUPLICATE KEY UPDATE value = 2", None]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in said], "s string").coalesce(1).select(projection.is_noise(F.col("s"))).collect()]
    assert got == [True, True, False, True, True, True, False, True, False]


def test_wire_message(spark):
    df = spark.createDataFrame([("value", "b<&>")], "key string, a string")
    events = df.select(F.struct("key").alias("key"), F.lit(None).cast("string").alias("before"), F.struct("a").alias("after"), envelope.source("table", F.lit(1000)).alias("source"), F.lit("c").alias("op"))
    row = envelope.message(events, F.lit("topic-prefix.topic-suffix")).first()
    assert row["key"] == '{"schema":{"type":"","fields":null,"optional":false,"field":""},"payload":{"key":"value"}}'
    assert row["value"] == '{"schema":{"type":"","fields":null},"payload":{"before":null,"after":{"a":"b\\u003c\\u0026\\u003e"},"source":{"connector":"","ts_ms":1000,"db":"","table":"table"},"op":"c"}}'


def test_snapshot_plan(spark):
    df = spark.createDataFrame([(1, None, "2020-01-02"), (2, "x", "0000-00-00")], "id int, s string, d string")
    plan = SnapshotPlan("t", ("id",), {"id": mysql.parse("int"), "d": mysql.parse("date"), "s": mysql.parse("varchar(3)")})
    rows = {r["after"]["id"]: r for r in plan.events(df, F.lit(5)).collect()}
    assert rows[1]["op"] == "r" and rows[1]["before"] is None and rows[1]["after"].asDict() == {"id": 1, "s": None, "d": 18263} and rows[2]["after"]["d"] is None
    block = json.loads(envelope.schema_block(plan.events(df, F.lit(5)).schema["after"].dataType, ["after"]))
    assert [f["type"] for f in block["fields"][0]["fields"]] == ["int32", "string", "int32"]
    assert warehouse_columns(block["fields"][0]["fields"], ["id"])[0] == {"name": "id", "kind": "int32", "key": True}


def test_update_pairs_and_keys(spark):
    df = spark.createDataFrame([([1, 2, 3, 4],)], "r array<int>")
    assert [tuple(p) for p in df.select(envelope.pair_updates(F.col("r")).alias("p")).first()["p"]] == [(1, 2), (3, 4)]
    with pytest.raises(PySparkException):
        spark.createDataFrame([([1],)], "r array<int>").select(envelope.pair_updates(F.col("r"))).collect()
    sides = spark.createDataFrame([((1, "a"), None), (None, (2, "b"))], "b struct<k:int,v:string>, a struct<k:int,v:string>")
    assert sorted(r[0][0] for r in sides.select(envelope.change_key(F.col("b"), F.col("a"), ["k"])).collect()) == [1, 2]
    with pytest.raises(PySparkException):
        sides.select(envelope.change_key(F.lit(None).cast("struct<k:int>"), F.lit(None).cast("struct<k:int>"), ["k"])).collect()


def test_document_changes(spark):
    rows = [("insert", "1", "c", '{"_id":1}', None), ("update", "2", "c", None, None), ("replace", "3", "c", '{"_id":3}', '{"o":1}'), ("delete", "4", "c", None, None)]
    df = spark.createDataFrame(rows, "operationType string, id string, coll string, full string, full_before string")
    got = {r["key"]: r for r in envelope.document_change(df).collect()}
    assert [got[k]["op"] for k in "1234"] == ["c", "u", "u", "d"] and got["2"]["after"] == '{"_id":2}' and got["4"]["after"] == '{"_id":4}' and got["3"]["before"] == '{"o":1}'
    for bad in (("insert", None, "c", "{}", None), ("drop", "1", "c", "{}", None), ("insert", "1", "c", None, None)):
        with pytest.raises(PySparkException):
            envelope.document_change(spark.createDataFrame([bad], df.schema)).collect()


def test_as_of_matches_brute_force(spark):
    draw = random.Random(2)
    items = [(draw.randint(0, 3), draw.randint(0, 200), i) for i in range(60)]
    asks = [(draw.randint(0, 4), draw.randint(-5, 205), i) for i in range(80)]
    left, right = spark.createDataFrame(asks, "k int, t int, id int"), spark.createDataFrame(items, "k int, at int, v int")
    got = {r["id"]: r["v"] for r in asof.as_of(left, right, ["k"], "t", "at", ["v"]).collect()}
    day = lambda c: F.timestamp_seconds(F.col(c) * 1000)
    cut = asof.bucketed_as_of(left.withColumn("t", day("t")), right.withColumn("at", day("at")), ["k"], "t", "at", ["v"], 7_000)
    bucketed = {r["id"]: r["v"] for r in cut.collect()}
    for k, t, i in asks:
        best = max(((at, v) for kk, at, v in items if kk == k and at <= t), default=(0, None))
        assert got[i] == bucketed[i] == best[1]


def test_merge_and_soft_delete(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    log = spark.createDataFrame([(1, "x", "u", 1), (1, "y", "u", 2), (2, "b", "d", 1), (4, "n", "c", 1), (5, "m", "c", 1), (5, "m", "d", 2)], "id int, v string, op string, pos int")
    assert sorted(map(tuple, changes.merge(target, log, ["id"], "op", ["pos"]).collect())) == [(1, "y"), (3, "c"), (4, "n")]
    assert sorted(map(tuple, changes.soft_delete(target, log, ["id"], "op", ["pos"], "gone").collect())) == [(1, "y", False), (2, "b", True), (3, "c", False), (4, "n", False)]
    assert sorted(map(tuple, changes.latest(log, ["id"], ["pos"]).collect()))[0] == (1, "y", "u", 2)


def test_replay_filter(spark):
    events = spark.createDataFrame([("a", 4), ("a", 5), ("a", 6), ("b", 1)], "sid string, tx long")
    seen = spark.createDataFrame([("a", 3), ("a", 5)], "sid string, stop long")
    assert sorted(map(tuple, changes.not_replayed(events, seen, "sid", "tx", "stop").collect())) == [("a", 5), ("a", 6), ("b", 1)]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("nope",)], "g string").select(changes.transaction(F.col("g"))[1]).collect()


def test_ready_shards(spark):
    rows = [("p", None, True, False), ("c", "p", True, False), ("q", None, True, True), ("d", "q", True, False), ("e", "gone", True, False)]
    df = spark.createDataFrame(rows, "id string, parent string, seen boolean, processed boolean")
    assert sorted(r[0] for r in changes.ready_shards(df, "id", "parent", "seen", "processed").collect()) == ["d", "e", "p"]


@pytest.mark.parametrize(
    ("declared", "name", "spark_type"),
    [
        ("tinyint(1)", "tinyint", "smallint"), ("BOOLEAN", "tinyint", "smallint"), ("tinyint unsigned", "smallint", "smallint"), ("int(10) unsigned", "bigint", "bigint"), ("mediumint", "mediumint", "int"),
        ("decimal(10,2)", "decimal", "decimal(10,2)"), ("decimal(50,2)", "decimal", "string"), ("bit(1)", "bit", "boolean"), ("bit(5)", "bit", "binary"), ("varchar(9) COLLATE utf8", "varchar", "string"),
        ("varchar(9) character set latin1 collate x", "varchar", "string"), ("multipolygon", "geometry", "struct<wkb: binary, srid: int>"), ("year", "year", "int"), ("datetime(6)", "datetime", "timestamp_ntz"),
    ],
)
def test_mysql_types(declared, name, spark_type):
    kind = mysql.parse(declared)
    assert (kind.name, kind.spark) == (name, spark_type)


def test_other_types():
    assert mysql.parse("ENUM('A','b')").values == ("A", "b") and mysql.parse("bigint unsigned", exact_unsigned=True).spark == "decimal(20,0)"
    for bad in ("decimal", "vector(3)", ""):
        with pytest.raises(UnknownType):
            mysql.parse(bad)
    assert postgres.parse("numeric").name == "variable numeric" and postgres.parse("USER-DEFINED", udt="hstore").spark == "map<string, string>" and postgres.parse("USER-DEFINED", udt="mood").spark == "string"
    assert mssql.parse("time", datetime_precision=3).wire == "int32" and mssql.parse("datetime2", datetime_precision=7).wire == "int64" and mssql.parse("smallmoney").scale == 4
    for f in (postgres.parse, mssql.parse):
        with pytest.raises(UnknownType):
            f("circle")
