"""Sharded logs: a partition for each shard that may be read.

An offset holds every listed shard with the last sequence number of the batch and whether the shard has ended. Children
wait until a batch has ended their parent. Planning pages through the records after the last batch, at most `pages` a
shard and trigger, and keeps sequence numbers alone; workers then read the records between the two offsets, so a batch
that is tried again is the same. Shards that have ended and are no longer listed leave the offset, which keeps it to
what the log still holds.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tideline.streaming.shards import Shard, ordered

SCHEMA = "shard string, seq string, eventName string, keys string, new string, old string, created timestamp"
#: Records a page, tries of a request, and the least and greatest pause between tries in seconds.
PAGE, TRIES, PAUSE, LONGEST = 1_000, 25, 0.1, 5.0


class Client(Protocol):
    """shards lists pages of shards; start gives an iterator at the oldest record, or after a sequence number; records
    gives a page of records (dicts of seq, eventName, keys, new, old, created) and the next iterator, None at the end."""

    def shards(self) -> list[list[Shard]]: ...

    def start(self, shard: str, kind: str, seq: str | None) -> str: ...

    def records(self, iterator: str, limit: int) -> tuple[list[dict], str | None]: ...


def tried(call: Callable, *given, tries: int = TRIES, pause: float = PAUSE):
    """The call's result; a failed one is tried again after growing random pauses, the last failure is raised."""
    for n in range(tries):
        try:
            return call(*given)
        except Exception:
            if n == tries - 1:
                raise
            time.sleep(random.uniform(0, min(LONGEST, pause * 2**n)))


def cloud_client(stream: str, region: str) -> Callable[[], Client]:
    """Clients of the cloud's own library, where it is installed."""

    def made() -> Client:
        import boto3

        api = boto3.client("dynamodbstreams", region_name=region)

        class Cloud:
            def shards(self) -> list[list[Shard]]:
                pages, last = [], {}
                while True:
                    found = api.describe_stream(StreamArn=stream, **last)["StreamDescription"]
                    pages.append([Shard(s["ShardId"], s.get("ParentShardId")) for s in found["Shards"]])
                    if not found.get("LastEvaluatedShardId"):
                        return pages
                    last = {"ExclusiveStartShardId": found["LastEvaluatedShardId"]}

            def start(self, shard: str, kind: str, seq: str | None) -> str:
                return api.get_shard_iterator(StreamArn=stream, ShardId=shard, ShardIteratorType=kind, **({"SequenceNumber": seq} if seq else {}))["ShardIterator"]

            def records(self, iterator: str, limit: int) -> tuple[list[dict], str | None]:
                got = api.get_records(ShardIterator=iterator, Limit=limit)
                rows = [(r["eventName"], r["dynamodb"]) for r in got["Records"]]
                made = [{"seq": d["SequenceNumber"], "eventName": n, "keys": d.get("Keys"), "new": d.get("NewImage"), "old": d.get("OldImage"), "created": d.get("ApproximateCreationDateTime")} for n, d in rows]
                return made, got.get("NextShardIterator")

        return Cloud()

    return made


class Part(InputPartition):
    def __init__(self, shard: str, after: str | None, last: str):
        self.shard, self.after, self.last = shard, after, last


def opened(client: Client, shard: str, after: str | None) -> str:
    return tried(client.start, shard, "AFTER_SEQUENCE_NUMBER" if after else "TRIM_HORIZON", after)


class ShardReader(DataSourceStreamReader):
    def __init__(self, client: Callable[[], Client], pages: int):
        self.client, self.pages, self.planned = client, pages, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        client = self.client()
        listed = ordered(tried(client.shards))
        names = {s.id for s in listed}
        before = {n: s for n, s in self.planned.items() if n in names or not s["ended"]}
        after = {**before, **{s.id: before.get(s.id, {"seq": None, "ended": False}) for s in listed}}
        for s in listed:
            # a parent that isn't known has left the log; one that ends in this very batch is waited for
            parent = before.get(s.parent, {"ended": False}) if s.parent in after else {"ended": True}
            if not after[s.id]["ended"] and parent["ended"]:
                after[s.id] = self._reach(client, s.id, after[s.id]["seq"])
        self.planned = after
        return after

    def _reach(self, client: Client, shard: str, seq: str | None) -> dict:
        """The last sequence number within `pages` pages, and whether the shard ends there."""
        iterator = opened(client, shard, seq)
        for _ in range(self.pages):
            found, iterator = tried(client.records, iterator, PAGE)
            seq = found[-1]["seq"] if found else seq
            if iterator is None:
                break
            if not found:
                break
        return {"seq": seq, "ended": iterator is None}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.planned = dict(end)
        old = lambda n: start.get(n, {"seq": None})["seq"]
        return [Part(n, old(n), s["seq"]) for n, s in end.items() if s["seq"] != old(n)]

    def read(self, part: Part):
        client = self.client()
        text = lambda v: None if v is None else json.dumps(v, separators=(",", ":"), ensure_ascii=False, default=str)
        iterator = opened(client, part.shard, part.after)
        while iterator is not None:
            found, iterator = tried(client.records, iterator, PAGE)
            for r in found:
                yield (part.shard, r["seq"], r["eventName"], text(r["keys"]), text(r["new"]), text(r["old"]), r["created"])
                if r["seq"] == part.last:
                    return
        raise RuntimeError(f"shard {part.shard} ends before {part.last}")

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def shard_log(spark: SparkSession, client: Callable[[], Client], pages: int = 10) -> DataFrame:
    """Records of all shards as a stream; keys and images as tagged JSON texts."""

    class ShardLog(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tideline_shards"

        def schema(self) -> str:
            return SCHEMA

        def streamReader(self, schema) -> DataSourceStreamReader:
            return ShardReader(client, pages)

    spark.dataSource.register(ShardLog)
    return spark.readStream.format("tideline_shards").load()
