"""From settings to written events: one snapshot, table after table, or one stream."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.text import topic
from tideline.operators import envelope
from tideline.plans.config import Settings, SourceConfig, TableConfig
from tideline.plans.snapshot import SnapshotPlan
from tideline.sinks.writers import TableSink, publish
from tideline.sources import documents, items, jdbc, registry
from tideline.streaming.metrics import counted

log = logging.getLogger("tideline")


def suffix(source: SourceConfig, table: TableConfig) -> list[str]:
    """Parts of a topic's name after its prefix, by kind of source."""
    return {
        "mysql": [source.database, table.name], "postgresql": [table.schema, table.name], "mssql": [source.database, table.schema, table.name],
        "mongodb": [source.database, table.name], "dynamodb": [table.name],
    }.get(source.kind, [x for x in (table.schema, table.name) if x])


def relational_events(spark: SparkSession, source: SourceConfig, table: TableConfig, plan: SnapshotPlan | None = None) -> DataFrame:
    known = plan or jdbc.load_plan(spark, source, table, source.options.get("sqlMode"))
    return known.events(registry.read(spark, source, table), F.lit(int(time.time() * 1000)))


def events(spark: SparkSession, source: SourceConfig, table: TableConfig, plan: SnapshotPlan | None = None) -> DataFrame:
    """A table's snapshot as change events."""
    rows = registry.read(spark, source, table) if source.kind in ("mongodb", "dynamodb") else None
    if source.kind == "mongodb":
        made = documents.snapshot(rows, table.name)
    elif source.kind == "dynamodb":
        made = items.snapshot(rows, table.name, list(table.keys)).withColumn("before", F.lit(None).cast("string"))
    else:
        return relational_events(spark, source, table, plan)
    return made.withColumn("source", envelope.source(table.name, F.lit(int(time.time() * 1000)))).select("key", "before", "after", "source", "op")


def snapshot(spark: SparkSession, given: Settings, plans: dict[str, SnapshotPlan] | None = None, tables: Callable[[TableConfig], TableSink] | None = None) -> dict[str, int]:
    """Write the snapshots of all tables; the number of rows by table."""
    done = {}
    for table in given.source.tables:
        made, seen = counted(events(spark, given.source, table, (plans or {}).get(table.name)), table.name)
        if given.sink.kind == "kafka":
            name = topic(given.sink.options["topicPrefix"], *map(F.lit, suffix(given.source, table)))
            publish(envelope.message(made, name), given.sink.options)
        else:
            # documents and items have images as text: their key's columns and the image make the table
            whole = isinstance(made.schema["after"].dataType, T.StructType)
            rows = made.select("after.*") if whole else made.select("key.*", F.col("after").alias("document"))
            keys = list(table.keys) if whole else made.schema["key"].dataType.names
            target = tables(table) if tables else TableSink(spark, f"{given.sink.options['path']}/{table.name}", keys)
            target.prepare(given.sink.options.get("beforeBackfill", "none"))
            target.append(rows, [])
        done[table.name] = seen.get["rows"]
        log.info("%s: %d rows", table.name, done[table.name])
    return done
