"""Replays, retried batches, repeated loads, typed ids and split batches; queries of single operators against their SQL."""

import json
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.ddl.registry import Registry, recover
from tideline.operators import changes, keyset
from tideline.plans import run, units
from tideline.plans.config import Settings, SinkConfig, SourceConfig, TableConfig
from tideline.sinks import writers
from tideline.sources import documents, jdbc
from tideline.streaming import apply, source
from tideline.streaming.offsets import HistoryFile


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


def trigger(water, *batches):
    frames = iter([pd.DataFrame(b, columns=["sid", "tx", "pos"]) for b in batches])
    return [tuple(r) for f in water.handleInputRows(("s",), frames, None) for r in f.itertuples(index=False)]


def test_transactions_of_many_rows_over_many_batches():
    water = apply.HighWater("pos")
    water.mark = Value()
    first = [[("s", 5, 1), ("s", 5, 2), ("s", 5, 3)], [("s", 3, 0), ("s", 5, 4)]]
    assert trigger(water, *first) == [r for b in first for r in b]
    # the transaction goes on in the next trigger; what was there is a replay
    assert trigger(water, [("s", 3, 0), ("s", 5, 4), ("s", 5, 5)], [("s", 6, 9)]) == [("s", 5, 5), ("s", 6, 9)]
    assert trigger(water, [("s", 5, 5), ("s", 6, 9)]) == [] and water.mark.held == (6, 9)
    plain = apply.HighWater()
    plain.mark = Value()
    assert len(trigger(plain, *first)) == 5 and trigger(plain, first[0]) == []


def test_stream_keeps_rows_of_one_transaction(spark, tmp_path):
    rows = [(f"s{i % 2}", i // 6, i) for i in range(36)]
    for part in range(3):
        spark.createDataFrame(rows[: 12 * (part + 1)], "sid string, tx long, pos long").coalesce(1).write.parquet(str(tmp_path / f"in/p{part}"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema("sid string, tx long, pos long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    seen = []
    query = apply.without_replays(stream, "sid", "sid string, tx long, pos long", "pos").writeStream.foreachBatch(lambda df, n: seen.extend(map(tuple, df.collect()))).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(seen) == sorted(rows)


def test_retried_batch_applies_its_statements_once(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    events = [
        {"kind": "query", "db": "d", "ts": 10, "body": {"query": "CREATE TABLE t (id INT PRIMARY KEY)"}},
        {"kind": "write_rows", "db": "d", "table": "t", "ts": 11, "body": {"id": 1}},
        {"kind": "query", "db": "d", "ts": 20, "body": {"query": "ALTER TABLE t ADD v INT"}},
        {"kind": "write_rows", "db": "d", "table": "t", "ts": 21, "body": {"id": 2}},
    ]
    (folder / "0.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events))
    history, got, failing = HistoryFile(str(tmp_path / "h")), [], [True]

    def put(df, n):
        if failing[0]:
            raise OSError("no space")
        got.extend(json.loads(r["body"])["id"] for r in df.collect())

    def drain(registry):
        query = source.log(spark, str(folder), 10).writeStream.foreachBatch(apply.Applier("d", history, registry, ["t"], put)).option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="no space"):
        drain(Registry())
    failing[0] = False
    drain(recover(history.entries(), None))
    assert sorted(got) == [1, 2] and [e["query"][:6] for e in history.entries()] == ["CREATE", "ALTER "]


def test_later_load_wins(spark, tmp_path):
    sink = writers.TableSink(spark, str(tmp_path / "t"), ["id"])
    for v in ("zeta", "alpha"):
        sink.append(spark.createDataFrame([(1, v)], "id int, v string"), [])
    assert [tuple(r) for r in sink.read().collect()] == [(1, "alpha")]


def test_documents_into_a_table(spark, tmp_path):
    (tmp_path / "in/c").mkdir(parents=True)
    path = tmp_path / "in/c/0.json"
    for v in (2, 1):
        path.write_text("".join(json.dumps({"_id": {"$numberInt": str(i)}, "v": v}) + "\n" for i in range(3)))
        given = Settings(SourceConfig("mongodb", tables=(TableConfig("c"),), options={"path": str(tmp_path / "in")}), SinkConfig("table", {"path": str(tmp_path / "out")}))
        assert run.snapshot(spark, given) == {"c": 3}
    rows = writers.TableSink(spark, str(tmp_path / "out/c"), ["id"]).read().collect()
    assert sorted(r["id"] for r in rows) == ["0", "1", "2"] and all(json.loads(r["document"])["v"] == 1 for r in rows)


def test_ids_compare_within_their_type(spark, tmp_path):
    oid = lambda n: {"$oid": f"{n:024x}"}
    ids = [{"$numberInt": "1"}, {"$numberLong": "2"}, 9, {"$numberInt": "10"}, {"$numberDouble": "20.0"}, "2", "10", "b", oid(2), oid(10), oid(200), {"$date": "2024-01-01"}]
    (tmp_path / "c.json").write_text("".join(json.dumps({"_id": i}) + "\n" for i in ids))
    found = lambda a, b: sorted(json.dumps(json.loads(r["document"])["_id"]) for r in documents.scan(spark, str(tmp_path / "c.json"), a, b).collect())
    assert found("2", "10") == sorted(map(json.dumps, [{"$numberLong": "2"}, 9, {"$numberInt": "10"}]))
    assert found("a", None) == ['"b"'] and found(f"{10:024x}", f"{100:024X}") == [json.dumps(oid(10))] and len(found(None, None)) == len(ids)


def test_unreadable_columns_stay_out(spark):
    rows = [("id", "integer", 32, 0, None, "int4", None), ("v", "tsvector", None, None, None, "tsvector", None)]
    kinds = jdbc.kinds_of("postgresql", rows)
    plan = jdbc.plan_of(TableConfig("t"), ["id"], kinds, tuple(r[0] for r in rows if r[0] not in kinds))
    assert plan.rows(spark.createDataFrame([(1, "'a':1")], "id int, v string")).columns == ["id"]


def test_batches_over_ranges_match_one_pass(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["a", "b", None]), i, draw.randint(1, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, n int").repartition(7)
    got = {r["i"]: r["batch"] for r in changes.batches_by_bytes(df, F.col("n"), ["i"], 200, "g").collect()}
    total = {}
    for g, i, n in rows:
        total[g] = total.get(g, 0) + n
        assert got[i] == (total[g] - 1) // 200
    assert changes.batches_by_bytes(df.where("false"), F.col("n"), ["i"], 200, "g").count() == 0


def test_overrides_by_more_types():
    assert str(keyset.parse_override("numeric", "1.50")) == "1.50" and keyset.parse_override("int8", "-5") == -5
    for kind, given in (("integer", "2147483648"), ("numeric", "1e5x"), ("uuid", "zz")):
        with pytest.raises(ValueError):
            keyset.parse_override(kind, given)


FIXED = [n for n, sql in units.ORACLE_SQL.items() if "VALUES" in sql and n != "write_then_commit"]  # that one reads tables


@pytest.mark.parametrize("name", FIXED)
def test_fixed_queries_match_their_sql(spark, name):
    df = units.QUERIES[name](spark, "")
    want = duckdb.connect().execute(units.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, want.fetchall()))
