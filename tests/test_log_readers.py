"""Logs, cursors and shards as streams: restarts, retried batches, order of shards; before images over ranges."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tideline.operators import envelope
from tideline.plans import units
from tideline.streaming import cursors, shard_log, source
from tideline.streaming.shards import Shard


def drained(stream, folder, got):
    query = stream.writeStream.foreachBatch(lambda df, n: got.extend(map(tuple, df.collect()))).option("checkpointLocation", str(folder)).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_log_goes_on_at_its_byte(spark, tmp_path):
    (tmp_path / "log").mkdir()
    path = tmp_path / "log/0.jsonl"
    event = lambda i: json.dumps({"kind": "write_rows", "db": "d", "table": "t", "ts": i, "body": {"v": "é" * i}}, ensure_ascii=False)
    path.write_text("".join(event(i) + "\n" for i in range(7)) + "\n" + event(7)[:20])
    (tmp_path / "log/1.jsonl").write_text(event(0))
    got = []
    read = lambda: source.log(spark, str(tmp_path / "log"), 3).select("shard", "pos", "ts")
    drained(read(), tmp_path / "ck", got)
    assert sorted(got) == [*(("0.jsonl", i, i) for i in range(7)), ("1.jsonl", 0, 0)]
    with path.open("a") as f:
        f.write(event(7)[20:] + "\n" + event(8) + "\n")
    drained(read(), tmp_path / "ck", got)
    assert sorted(got) == [*(("0.jsonl", i, i) for i in range(9)), ("1.jsonl", 0, 0)]


def test_cursor_stream_resumes(spark, tmp_path):
    changes = [{"operationType": "update" if i % 3 else "insert", "documentKey": {"_id": {"$numberInt": str(i)}}, "ns": {"coll": "ab"[i % 2]}, "clusterTime": {"$timestamp": {"t": i, "i": 1}}, "fullDocument": None if i % 3 else {"v": "é"}} for i in range(12)]
    path = tmp_path / "changes.json"
    name = str(path)

    def opened(kinds, before, token):
        class Held:
            def __init__(self):
                self.at = int(token or 0)

            def try_next(self):
                with open(name) as f:
                    rows = json.load(f)
                if self.at == len(rows):
                    return None
                self.at += 1
                return str(self.at).encode(), rows[self.at - 1]

        assert kinds == ["delete", "insert", "replace", "update"]
        return Held()

    got = []
    for known in (7, 7, 12):
        path.write_text(json.dumps(changes[:known]))
        stream = cursors.change_stream(spark, opened, ["a"], 2)
        drained(envelope.document_change(stream), tmp_path / "ck", got)
    assert sorted(int(json.loads(r[1])["$numberInt"]) for r in got) == [0, 2, 4, 6, 8, 10]
    assert {r[0] for r in got} == {"a"} and {r[3] for r in got if r[4] == "c"} == {'{"v":"é"}'}
    assert ('{"_id":{"$numberInt":"2"}}', "u") in {r[3:] for r in got}


def test_shard_stream_keeps_parents_first(spark, tmp_path):
    def client():
        class Held:
            def shards(self):
                return [[Shard("c", "p"), Shard("p")], [Shard("g", "c")]]

            def start(self, shard, kind, seq):
                assert (kind == "TRIM_HORIZON") == (seq is None)
                return f"{shard}:{int(seq[1:]) + 1 if seq else 0}"

            def records(self, iterator, limit):
                shard, at = iterator.split(":")
                end = min(int(at) + 4, 10)
                rows = [{"seq": f"{shard}{i}", "eventName": "REMOVE", "keys": {"id": {"N": str(i)}}, "new": None, "old": {"id": {"N": str(i)}}, "created": None} for i in range(int(at), end)]
                return rows, None if end == 10 else f"{shard}:{end}"

        return Held()

    got = []
    for _ in range(2):
        drained(shard_log.shard_log(spark, client, 2).select("shard", "seq", "keys", "old"), tmp_path / "ck", got)
    assert [r[1] for r in got] == [f"{s}{i}" for s in "pcg" for i in range(10)]
    assert got[3][2:] == ('{"id":{"N":"3"}}', '{"id":{"N":"3"}}')


def test_failed_requests_are_tried_again():
    calls = []

    def failing(x):
        calls.append(x)
        if len(calls) < 3:
            raise ConnectionError
        return x

    assert shard_log.tried(failing, 5, pause=0.0) == 5 and len(calls) == 3
    with pytest.raises(ZeroDivisionError):
        shard_log.tried(lambda: 1 / 0, tries=2, pause=0.0)


def test_records_that_have_gone_are_an_error():
    client = units.ListedShards([Shard("p")], {"p": ["p1", "p2"]})
    reader = shard_log.ShardReader(lambda: client, 1)
    with pytest.raises(RuntimeError, match="p ends before p9"):
        list(reader.read(shard_log.Part("p", None, "p9")))


def test_before_images_over_ranges_match_one_window(spark):
    draw = random.Random(4)
    rows = [(draw.choice([1, 1, 1, 2, None]), i, draw.choice([None, i * 10])) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, at int, v int").repartition(9)
    got = {r["at"]: (r["before"], r["after"]) for r in envelope.with_before(df, ["k"], ["at"], ["k", "v"]).collect()}
    last = {}
    for k, at, v in rows:
        assert got[at] == (last.get(k), (k, v))
        last[k] = (k, v)
    assert envelope.with_before(df.where("false"), ["k"], ["at"], ["v"]).count() == 0
    assert envelope.with_before(df.withColumn("_part", F.lit(1)), ["k"], ["at"], ["v"]).columns == ["k", "at", "v", "_part", "before", "after"]


def test_source_block_matches_its_sql(spark, tmp_path):
    spark.sql("SELECT id AS event_id, timestamp_millis(id * 1234567) AS ts, id % 5 AS user_id, 'click' AS event_type FROM range(50)").write.parquet(str(tmp_path / "events.parquet"))
    want = duckdb.connect().execute(units.ORACLE_SQL["source_block"].replace("FROM events", f"FROM '{tmp_path}/events.parquet/*.parquet'"))
    names = [c[0] for c in want.description]
    got = units.QUERIES["source_block"](spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
