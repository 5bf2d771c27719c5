"""Applying a stream of log events: statements change the schema, rows become events, whole transactions are filtered."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tideline.ddl.registry import Registry, replay
from tideline.operators.projection import is_noise, of_database, routed
from tideline.streaming.offsets import HistoryFile


def new_events(events: DataFrame, database: str) -> DataFrame:
    """Statements and row events of the database, noise left out, with where each goes."""
    return events.where(of_database(F.col("db"), database)).withColumn("route", routed(F.col("kind"))).where(
        (F.col("route") == "dml") | (F.col("route") == "ddl") & ~is_noise(F.get_json_object("body", "$.query")) & (F.coalesce(F.get_json_object("body", "$.error_code").cast("int"), F.lit(0)) == 0)
    )


def places(history: list[dict]) -> set[tuple]:
    """Where in the log the entries of a history were, as far as that is known."""
    return {(e["shard"], e["pos"]) for e in history if "shard" in e}


def schema_spans(statements: list[tuple[str, int, str, int]], registry: Registry, history: HistoryFile) -> list[tuple[str, int, Registry]]:
    """The registry from each position on; statements: (shard, position, query, ts) in log order."""
    spans = [("", -1, registry)]
    known = places(history.entries())
    for shard, pos, query, ts in statements:
        registry = registry.apply(query, ts)
        if (shard, pos) not in known:
            history.push({"query": query, "unixTs": ts, "shard": shard, "pos": pos})
        spans.append((shard, pos, registry))
    return spans


def since(spans: list[tuple[str, int, Registry]]) -> Column:
    """When the schema that a row meets at its place in the log was made; null without a schema."""
    out = F.lit(None).cast("long")
    for shard, pos, registry in spans:
        here = F.lit(None).cast("long")
        for name, version in registry.tables.items():
            here = F.when(F.col("tbl") == name, F.lit(version.since)).otherwise(here)
        out = F.when((F.col("shard") > shard) | (F.col("shard") == shard) & (F.col("pos") > pos), here).otherwise(out)
    return out


class Applier:
    """foreachBatch: splits a batch at its statements, so that each row meets the schema that was valid when it was written.

    A batch that is tried again, as after a restart, finds its statements in the history and applies them once. Statements
    of a batch are few and come to the driver; rows stay in the cluster. Rows older than their schema go.
    """

    def __init__(self, database: str, history: HistoryFile, registry: Registry, tables: list[str], write: Callable[[DataFrame, int], None]):
        self.database, self.history, self.registry, self.tables, self.write = database, history, registry, tables, write

    def __call__(self, batch: DataFrame, number: int) -> None:
        found = new_events(batch, self.database).persist()
        try:
            said = found.where("route = 'ddl'").select("shard", "pos", F.get_json_object("body", "$.query").alias("q"), "ts").orderBy("shard", "pos").collect()
            here, past = {(r["shard"], r["pos"]) for r in said}, self.history.entries()
            if here & places(past):
                # the batch was begun before: its rows meet the schema from before its statements
                self.registry = replay([e for e in past if (e.get("shard"), e.get("pos")) not in here])
            spans = schema_spans([tuple(r) for r in said], self.registry, self.history)
            self.registry = spans[-1][-1]
            rows = found.where((F.col("route") == "dml") & F.col("tbl").isin(self.tables)).withColumn("schema_since", since(spans))
            self.write(rows.where(F.col("schema_since") <= F.col("ts")).drop("route"), number)
        finally:
            found.unpersist()


class HighWater(StatefulProcessor):
    """Per server, the highest transaction that earlier triggers have let through, and the highest place in the log within
    it; what is at or below that mark is a replay. All rows of a trigger meet the mark of its start, so a transaction may
    have many rows, in any order and in many batches."""

    def __init__(self, at: str | None = None):
        self.at = at

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", "tx long, at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = top = tuple(self.mark.get()) if self.mark.exists() else (-1, -1)
        for batch in rows:
            at = batch[self.at] if self.at else pd.Series(-1, batch.index)
            new = (batch["tx"] > before[0]) | (batch["tx"] == before[0]) & (at > before[1])
            if new.any():
                tx = int(batch["tx"][new].max())
                top = max(top, (tx, int(at[new & (batch["tx"] == tx)].max())))
                yield batch[new]
        self.mark.update(top)

    def close(self) -> None:
        pass


def without_replays(stream: DataFrame, sid: str, schema: str, at: str | None = None) -> DataFrame:
    """A stream without rows at or below their server's mark; needs the RocksDB state store. `at` is the column of a row's
    place in the log: with it a transaction's rows may come over several triggers, without it they must come in one."""
    return stream.groupBy(sid).transformWithStateInPandas(HighWater(at), schema, "append", "None")
