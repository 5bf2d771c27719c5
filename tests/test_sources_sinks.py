"""Sources, sinks, settings and streams."""

import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tideline.ddl.registry import Registry
from tideline.plans.config import ConfigError, SinkConfig, SourceConfig, TableConfig, settings
from tideline.sinks import writers
from tideline.sources import documents, items, jdbc, registry
from tideline.streaming import apply, shards, source
from tideline.streaming.offsets import HistoryFile, Position, StateFile, TtlMap


def test_settings():
    kafka = {"bootstrapServers": "b:9092", "topicPrefix": "p"}
    given = {"source": "mysql", "mysql": {"host": "h", "port": 3306, "username": "u", "password": "p", "database": "d", "tables": [{"name": "t", "excludeColumns": ["x"]}]}, "kafka": kafka}
    s = settings(given)
    assert s.source.url == "jdbc:mysql://h:3306/d" and s.source.tables[0].batch_size == 5000 and s.sink.kind == "kafka"
    for change in ({"port": 0}, {"port": 70000}, {"tables": []}, {"host": ""}, {"tables": [{"name": "t", "excludeColumns": ["a"], "includeColumns": ["b"]}]}, {"streamingSettings": {"enabled": True}}):
        with pytest.raises(ConfigError):
            settings({**given, "mysql": {**given["mysql"], **change}})
    for change in ({"source": "oracle"}, {"kafka": {}}, {"destination": "x"}, {"kafka": {**kafka, "authMechanism": "magic"}}):
        with pytest.raises(ConfigError):
            settings({**given, **change})
    item = settings({"dynamodb": {"tableName": "t", "awsRegion": "r", "snapshot": True, "snapshotSettings": {"s3Bucket": "b", "folder": "f"}}, "kafka": kafka})
    assert item.source.kind == "dynamodb" and not item.source.streaming


def test_key_ranges_cover_once():
    for low, high, parts in ((1, 100, 7), (5, 5, 4), (0, 3, 16), (-10, 10, 3)):
        predicates = jdbc.Split("k", low, high, parts).predicates()
        import sqlite3

        con = sqlite3.connect(":memory:")
        con.execute("create table t (k int)")
        con.executemany("insert into t values (?)", [(i,) for i in range(low - 3, high + 4)])
        found = [con.execute(f"select count(*) from t where {p}").fetchone()[0] for p in predicates]
        assert sum(found) == high - low + 7


def test_jdbc_scan(spark, tmp_path):
    """A table in an embedded database, written and read by ranges, with a pushed filter."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark.range(1, 1001).select(F.col("id").alias("ID"), (F.col("id") % 7).alias("V")).write.format("jdbc").options(url=url, driver=jdbc.DRIVERS["derby"], dbtable="T").save()
    where = SourceConfig("derby", options={"url": url})
    df = jdbc.scan(spark, where, TableConfig("T", keys=("ID",)), 4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 1000 and df.select("ID").distinct().count() == 1000
    kept = df.where("ID > 990").select("ID")
    assert "GreaterThan(ID,990)" in kept._jdf.queryExecution().executedPlan().toString() and kept.count() == 10
    assert registry.read(spark, where, TableConfig("T", keys=("ID",))).count() == 1000
    with pytest.raises(ValueError):
        registry.read(spark, SourceConfig("nope"), TableConfig("T"))


def test_jdbc_ranges_of_any_key(spark, tmp_path):
    """Texts, composite keys with a hot first column, decimals and dates are cut into even ranges that cover all rows once."""
    url = f"jdbc:derby:{tmp_path}/keys;create=true"
    made = spark.range(1000).select(
        F.when(F.col("id") < 900, 1).otherwise(F.col("id")).alias("TENANT"), F.concat(F.lit("o'k "), F.col("id")).alias("NAME"), F.col("id").alias("ID"),
        (F.col("id") / 4).cast("decimal(12,2)").alias("AMOUNT"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("DAY"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("GAPS"),
        (F.col("id") / 3).alias("RATIO"), F.concat(F.lit("\\\\"), F.col("id")).alias("PATH"),
    )
    made.write.format("jdbc").options(url=url, driver=jdbc.DRIVERS["derby"], dbtable="T", createTableColumnTypes="NAME VARCHAR(40), PATH VARCHAR(40)").save()
    where = SourceConfig("derby", options={"url": url, "partitions": "5"})
    for keys, most in ((("NAME",), 200), (("TENANT", "ID"), 200), (("TENANT", "NAME", "ID"), 200), (("AMOUNT",), 200), (("DAY", "ID"), 200), (("GAPS", "ID"), 280), (("GAPS",), 300), (("RATIO",), 1000), (("PATH",), 1000)):
        df = jdbc.scan(spark, where, TableConfig("T", keys=keys))
        sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 1000 and df.select("ID").distinct().count() == 1000, keys
        assert max(sizes) <= most and len(sizes) == (5 if most < 1000 else 1), (keys, sizes)


@pytest.mark.parametrize("soft", [False, True])
def test_change_sets_over_a_table(spark, tmp_path, soft):
    """Batches write their own rows; the table read is the one that applying them one by one to a dict gives."""
    sink = writers.TableSink(spark, str(tmp_path / "t"), ["id"], soft_delete=soft)
    rows = spark.range(20_000).select("id", F.concat(F.lit("first "), F.sha2(F.col("id").cast("string"), 256)).alias("v"), F.lit(0).cast("long").alias("at"))
    sink.append(rows, [])
    want = {r["id"]: (r["v"], False) for r in rows.collect()}
    batches = [
        [(1, "a", 1, "u"), (1, "b", 2, "d"), (2, "c", 1, "u"), (50_000, "n", 1, "c"), (60_000, "x", 1, "d")],
        [(1, "again", 3, "c"), (2, "z", 4, "d"), (50_000, "m", 2, "u"), (70_000, "y", 1, "c"), (70_000, "y", 2, "d")],
        [(50_000, "m", 3, "d"), (3, None, 3, "u"), (2, "w", 1, "u")],
    ]
    for i, batch in enumerate(batches):
        sink.merge(spark.createDataFrame(batch, "id long, v string, at long, op string"), "op", ["at"])
        for key, v, _, op in sorted(batch, key=lambda r: r[2]):
            last = max(r[2] for r in batch if r[0] == key)
            if _ != last:
                continue
            if op != "d":
                want[key] = (v, False)
            elif key in want and soft:
                want[key] = (want[key][0], True)
            else:
                want.pop(key, None)
        got = {r["id"]: (r["v"], r[writers.DELETED] if soft else False) for r in sink.read().collect()}
        assert got == want and len(sink.versions()) == i + 2, i
    sink.append(spark.createDataFrame([(4, "later", 0)], "id long, v string, at long"), [])
    assert sink.read().where("id = 4").first()["v"] == "later" and len(sink.versions()) == 5
    sink.append(rows, [])  # half the bytes of the table: the next version is a whole one
    after = {r["id"]: r["v"] for r in sink.read().collect()}
    assert len(sink._current()) == 1 and after[4].startswith("first") and sorted(after) == sorted({*want, *range(20_000)})
    assert sink.vacuum(1) == 6 and sink.read().count() == len(after) and sink.vacuum(5) == 0
    sink.merge(spark.createDataFrame([(5, "e", 1, "u")], "id long, v string, at long, op string"), "op", ["at"])
    assert sink.read().where("id = 5").first()["v"] == "e"


def test_key_literals():
    assert jdbc.literal("postgresql", "it's") == "'it''s'" and jdbc.literal("mssql", "a") == "N'a'" and jdbc.literal("mysql", "a\\b") is None
    assert jdbc.literal("mysql", 5) == "5" and jdbc.literal("mysql", True) is None and jdbc.literal("mysql", 1.5) is None and jdbc.literal("mysql", None) is None
    assert jdbc.tuple_ranges(["a"], []) == ["1=1"]


def test_preflight():
    assert jdbc.check_streaming({"binlog_format": "row", "sql_mode": "ANSI,REAL_AS_FLOAT"}) == ["ANSI", "REAL_AS_FLOAT"]
    with pytest.raises(jdbc.PreflightError):
        jdbc.check_streaming({"binlog_format": "STATEMENT"})
    assert jdbc.uses_gtid({"gtid_mode": "ON", "enforce_gtid_consistency": "ON"}) and not jdbc.uses_gtid({"gtid_mode": "ON"})
    assert jdbc.quoted("mysql", "a`b") == "`a``b`" and jdbc.quoted("mssql", "a]b") == "[a]]b]" and jdbc.quoted("postgresql", "a") == '"a"'


def test_item_export(spark, tmp_path):
    lines = [json.dumps({"Item": {"id": {"S": f"k{i}"}, "n": {"N": str(i)}, "z": {"NULL": True}}}) for i in range(20)]
    for part in (0, 1):
        with gzip.open(tmp_path / f"p{part}.json.gz", "wt") as f:
            f.write("\n".join(lines[part::2]) + "\n")
    events = items.snapshot(items.scan(spark, str(tmp_path)), "t", ["id"])
    got = {r["key"]["id"]: r for r in events.collect()}
    assert len(got) == 20 and json.loads(got["k7"]["after"]) == {"id": "k7", "n": 7.0, "z": None} and json.loads(got["k7"]["schema"]) == {"id": "string", "n": "float"}
    with pytest.raises(PySparkException):
        items.snapshot(items.scan(spark, str(tmp_path)), "t", ["none"]).collect()
    assert items.bucket_and_prefix("s3://b/p/q") == ("b", "p/q") and items.data_folder("x/manifest-summary.json") == "x/data/"
    for bad in (lambda: items.bucket_and_prefix("b/p"), lambda: items.data_folder("x.json"), lambda: items.bucket_and_prefix("s3://b")):
        with pytest.raises(ValueError):
            bad()
    told, slept = iter(["IN_PROGRESS", "COMPLETED"]), []
    old = [{"status": "FAILED", "bucket": "b", "prefix": "p"}, {"status": "COMPLETED", "bucket": "b", "prefix": "p", "id": 2}]
    assert items.await_export(lambda: {}, lambda e: next(told), old, "b", "p", slept.append)["id"] == 2 and slept == [30.0]


def test_document_files(spark, tmp_path):
    rows = [{"_id": {"$oid": "a1"}, "v": 1}, {"_id": "s", "v": 2}, {"_id": {"$numberInt": "7"}}]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.json").write_text("\n".join(json.dumps(r, separators=(",", ":")) for r in rows))
    got = {r["id"] for r in documents.scan(spark, str(tmp_path / "c")).collect()}
    assert got == {'{"$oid":"a1"}', "s", "7"}
    assert documents.scan(spark, str(tmp_path / "c"), "s", "s").count() == 1
    assert registry.read(spark, SourceConfig("mongodb", options={"path": str(tmp_path)}), TableConfig("c")).count() == 3
    assert documents.snapshot(documents.scan(spark, str(tmp_path / "c")), "c").first()["op"] == "r"


def test_table_sink(spark, tmp_path):
    sink = writers.TableSink(spark, str(tmp_path / "t"), ["id"])
    assert sink.read() is None
    sink.create_empty(spark.createDataFrame([(1, "a", 1)], "id int, v string, at int"))
    assert sink.read().count() == 0 and sink.read().columns == ["id", "v", "at"]
    sink.append(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id int, v string, at int"), ["at"])
    assert sorted(map(tuple, sink.read().collect())) == [(1, "b", 2), (2, "c", 1)]
    sink.merge(spark.createDataFrame([(1, "b", 3, "d"), (3, "n", 3, "c")], "id int, v string, at int, op string"), "op", ["at"])
    assert sorted(map(tuple, sink.read().collect())) == [(2, "c", 1), (3, "n", 3)]
    sink.prepare("truncate")
    assert sink.read().count() == 0
    sink.prepare("drop")
    assert sink.read() is None
    soft = writers.sink(SinkConfig("table", {"path": str(tmp_path / "s"), "softDelete": True}), spark, ["id"])
    soft.append(spark.createDataFrame([(1, "a", 1)], "id int, v string, at int"), ["at"])
    soft.merge(spark.createDataFrame([(1, "a", 2, "d")], "id int, v string, at int, op string"), "op", ["at"])
    assert soft.read().first()[writers.DELETED] is True


def test_writer_loop_commits_after_writing(spark):
    done = []
    df = spark.range(2)
    n = writers.write([df, df.where("false"), df], lambda b: done.append("put"), lambda: done.append("commit"), lambda: done.append("end"))
    assert n == 4 and done == ["put", "commit", "put", "commit", "end"]
    done.clear()
    assert writers.write([df.where("false")], lambda b: done.append("put"), lambda: None, lambda: done.append("end")) == 0 and not done
    options = writers.kafka_options({"bootstrapServers": "x", "authMechanism": "scram-sha-512", "username": "u", "password": "p"})
    assert options["kafka.sasl.mechanism"] == "SCRAM-SHA-512" and options["kafka.compression.type"] == "gzip"


def test_positions():
    p = Position().rotated("f2", 4).begun("a:5")
    assert not p.replayed("a:5") and p.ended().seen == {"a": 5} and p.ended().replayed("a:4") and not p.ended().replayed("a:5") and not p.ended().replayed("b:1")
    assert Position.of_json(p.ended().to_json()) == p.ended()
    with pytest.raises(ValueError):
        p.replayed("bad")


def test_stores(tmp_path):
    now = [0.0]
    store = StateFile(str(tmp_path / "s.json"))
    m = TtlMap(lambda: now[0], store)
    m.set("a", 1, 10)
    m.set("b", 2, 10, keep=False)
    m.flush()
    assert TtlMap(lambda: now[0], StateFile(str(tmp_path / "s.json"))).get("a") == 1
    assert TtlMap(lambda: now[0], StateFile(str(tmp_path / "s.json"))).get("b") is None
    now[0] = 10.0
    assert m.get("a") is None
    history = HistoryFile(str(tmp_path / "h"))
    assert history.entries() == []
    history.push({"query": "x", "unixTs": 1})
    assert history.entries() == [{"query": "x", "unixTs": 1}]


def test_shards():
    states = shards.ShardStates(TtlMap(lambda: 0.0))
    S = shards.Shard
    order = shards.discover([[S("c", "p"), S("g", "c")], [S("p")]], states)
    assert [s.id for s in order] == ["p", "c", "g"] and states.waits(S("c", "p")) and not states.waits(S("p")) and not states.waits(S("x", "unknown"))
    assert states.start("p") and not states.start("p")
    states.finish("p")
    assert not states.waits(S("c", "p")) and [s.id for s in shards.discover([[S("p"), S("c", "p")]], states)] == ["c"]
    assert states.start_at("c") == ("TRIM_HORIZON", None)
    states.move("c", "42")
    assert states.start_at("c") == ("AFTER_SEQUENCE_NUMBER", "42")


def test_stream_applies_statements_and_rows(spark, tmp_path):
    """A log of statements and rows through the stream source; restarts go on where the checkpoint is."""
    folder = tmp_path / "log"
    folder.mkdir()
    events = [
        {"kind": "query", "db": "d", "ts": 10, "body": {"query": "CREATE TABLE t (id INT PRIMARY KEY)"}},
        {"kind": "write_rows", "db": "d", "table": "t", "ts": 5, "body": {"id": 0}},
        *[{"kind": "write_rows", "db": "D", "table": "t", "ts": 11 + i, "body": {"id": i}} for i in range(1, 8)],
        {"kind": "query", "db": "d", "ts": 30, "body": {"query": "BEGIN"}},
        {"kind": "query", "db": "d", "ts": 31, "body": {"query": "ALTER TABLE t ADD v INT"}},
        {"kind": "write_rows", "db": "other", "table": "t", "ts": 40, "body": {"id": 99}},
        {"kind": "write_rows", "db": "d", "table": "u", "ts": 40, "body": {"id": 98}},
    ]
    (folder / "0.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events))
    got, history = [], HistoryFile(str(tmp_path / "h"))
    applier = apply.Applier("d", history, Registry(), ["t"], lambda df, n: got.extend(json.loads(r["body"])["id"] for r in df.collect()))

    def drain():
        query = source.log(spark, str(folder), 4).writeStream.foreachBatch(applier).option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()

    drain()
    assert sorted(got) == list(range(1, 8)) and [c.name for c in applier.registry.tables["t"].columns] == ["id", "v"] and len(history.entries()) == 2
    with open(folder / "0.jsonl", "a") as f:
        f.write(json.dumps({"kind": "write_rows", "db": "d", "table": "t", "ts": 50, "body": {"id": 100}}) + "\n")
    drain()
    assert sorted(got) == [*range(1, 8), 100]


def test_stream_without_replays(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i % 3}", i) for i in range(30)], "sid string, tx long")
    for part in range(2):
        rows.coalesce(1).write.parquet(str(tmp_path / f"in/p{part}"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    seen = []
    query = apply.without_replays(stream, "sid", "sid string, tx long").writeStream.foreachBatch(lambda df, n: seen.extend(map(tuple, df.collect()))).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(seen) == sorted((f"s{i % 3}", i) for i in range(30))


def test_snapshot_run_from_settings(spark, tmp_path):
    """Settings to messages and to a table, over an embedded database with declared types."""
    from tideline.plans import run
    from tideline.types import mysql

    url = f"jdbc:derby:{tmp_path}/run;create=true"
    frame = spark.createDataFrame([(1, "12.50", "a"), (2, None, "b"), (3, "0.01", "c")], "ID int, PRICE string, NAME string").withColumn("PRICE", F.col("PRICE").cast("decimal(10,2)"))
    frame.write.format("jdbc").options(url=url, driver=jdbc.DRIVERS["derby"], dbtable="T").save()
    table = TableConfig("T", keys=("ID",), start="2", end="3")
    plan = jdbc.plan_of(table, ["ID"], {"ID": mysql.parse("int"), "PRICE": mysql.parse("decimal(10,2)")})
    where = SourceConfig("derby", tables=(table,), options={"url": url})
    from tideline.plans.config import Settings

    out = str(tmp_path / "messages")
    assert run.snapshot(spark, Settings(where, SinkConfig("kafka", {"topicPrefix": "p", "path": out})), {"T": plan}) == {"T": 2}
    rows = {json.loads(r["key"])["payload"]["ID"]: r for r in spark.read.json(out).collect()}
    assert set(rows) == {2, 3} and rows[3]["topic"] == "p.T" and json.loads(rows[3]["value"])["payload"]["after"] == {"ID": 3, "PRICE": "AQ==", "NAME": "c"}
    assert json.loads(rows[2]["value"])["payload"]["after"]["PRICE"] is None
    path = str(tmp_path / "tables")
    assert run.snapshot(spark, Settings(where, SinkConfig("table", {"path": path, "beforeBackfill": "drop"})), {"T": plan}) == {"T": 2}
    assert writers.TableSink(spark, f"{path}/T", ["ID"]).read().count() == 2


def test_catalogue_rows_to_kinds():
    rows = [("id", "integer", 32, 0, None, "int4", None), ("v", "tsvector", None, None, None, "tsvector", None), ("h", "USER-DEFINED", None, None, None, "hstore", None), ("n", "numeric", 7, 2, None, "numeric", None)]
    kinds = jdbc.kinds_of("postgresql", rows)
    assert list(kinds) == ["id", "h", "n"] and kinds["n"].spark == "decimal(7,2)"
    jdbc.check_keys("postgresql", ["id"], {"id": "integer"})
    for keys, declared in (([], {}), (["h"], {"h": "USER-DEFINED"})):
        with pytest.raises(ValueError):
            jdbc.check_keys("postgresql", keys, declared)
    assert jdbc.kinds_of("mysql", [("a", "enum('x','y')")])["a"].values == ("x", "y")
    assert jdbc.kinds_of("mssql", [("a", "datetime2", None, None, 7)])["a"].wire == "int64"
    with pytest.raises(ValueError):
        jdbc.kinds_of("oracle", [])


def test_progress_listener(spark, tmp_path):
    import time

    from tideline.streaming.metrics import Progress, lag_ms

    told = []
    listener = Progress(lambda name, value, tags: told.append((name, value)))
    spark.streams.addListener(listener)
    try:
        spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in"))
        query = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.foreachBatch(lambda df, n: df.count()).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination()
        for _ in range(100):
            if listener.batches:
                break
            time.sleep(0.1)
        assert ("stream.rows", 5) in told and listener.rows == 5
    finally:
        spark.streams.removeListener(listener)
    assert lag_ms(spark.range(3), "id", F.lit(10)).first()[0] == 10
