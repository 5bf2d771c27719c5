"""Change events: key, before and after images, operation and source, as structs; JSON only at the wire."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.numeric import fail
from tideline.functions.text import escaped_json
from tideline.session import fresh, settled

LOG_OPS = {"INSERT": "c", "MODIFY": "u", "REMOVE": "d"}
DOCUMENT_OPS = {"insert": "c", "update": "u", "replace": "u", "delete": "d"}
ROW_OPS = {"write_rows": "c", "update_rows": "u", "delete_rows": "d"}


def mapped_op(kind: Column, ops: dict[str, str], other: str | None = None) -> Column:
    """c, u or d by a source's name; other names give `other`, or an error where there is none."""
    out = F.lit(None)
    chain = None
    for name, op in ops.items():
        chain = F.when(kind == name, op) if chain is None else chain.when(kind == name, op)
    out = F.lit(other) if other else fail("unknown operation: ", kind)
    return chain.otherwise(out)


def source(table: str, ts_ms: Column, connector: str = "", db: str = "", **more: Column) -> Column:
    parts = [F.lit(connector).alias("connector"), ts_ms.cast("long").alias("ts_ms"), F.lit(db).alias("db"), F.lit(table).alias("table")]
    return F.struct(*parts, *[c.alias(n) for n, c in more.items()])


def log_source(connector: str) -> Column:
    """Source block of a log's events: their database, table, time, file, position and transaction."""
    ms = (F.col("ts") * 1000).cast("long").alias("ts_ms")
    return F.struct(F.lit(connector).alias("connector"), ms, F.col("db"), F.col("tbl").alias("table"), F.col("shard").alias("file"), "pos", F.coalesce("gtid", F.lit("")).alias("gtid"))


def snapshot(df: DataFrame, keys: list[str], table: str, ts_ms: Column, converted: dict[str, Column] | None = None) -> DataFrame:
    """Rows as events with op r: key of converted values, before null, after all columns."""
    converted = converted or {}
    value = lambda c: converted.get(c, F.col(c)).alias(c)
    after = F.struct(*[value(c) for c in df.columns])
    kind = df.select(after.alias("a")).schema["a"].dataType
    return df.select(
        F.struct(*[value(k) for k in keys]).alias("key"), F.lit(None).cast(kind).alias("before"), after.alias("after"), source(table, ts_ms).alias("source"), F.lit("r").alias("op"),
    )


def change_key(before: Column, after: Column, keys: list[str]) -> Column:
    """Key values from after, or from before where there is no after; an error where there is neither."""
    image = lambda k: F.when(after.isNotNull(), after[k]).otherwise(before[k])
    return F.when(before.isNull() & after.isNull(), fail("neither before nor after")).otherwise(F.struct(*[image(k).alias(k) for k in keys]))


def change(df: DataFrame, keys: list[str], before: str, after: str, op: Column, origin: Column) -> DataFrame:
    """Events from columns with both images; a missing image is null."""
    return df.select(change_key(F.col(before), F.col(after), keys).alias("key"), F.col(before).alias("before"), F.col(after).alias("after"), origin.alias("source"), op.alias("op"))


def pair_updates(rows: Column) -> Column:
    """An array of alternating before and after rows as an array of struct<before, after>; an odd number is an error."""
    pairs = F.transform(F.sequence(F.lit(0), F.floor(F.size(rows) / 2).cast("int") - 1), lambda i: F.struct(F.get(rows, 2 * i).alias("before"), F.get(rows, 2 * i + 1).alias("after")))
    none = F.slice(F.transform(rows, lambda r: F.struct(r.alias("before"), r.alias("after"))), 1, 0)
    return F.when(F.size(rows) % 2 == 1, fail("an update has pairs of rows")).when(F.size(rows) == 0, none).otherwise(pairs)


def with_before(df: DataFrame, keys: list[str], order: list[str], images: list[str]) -> DataFrame:
    """Before images from a key's own earlier event, for logs that have after images only.

    A key may have most of all events, so events are dealt out by ranges of key and order; the first of a key in its
    range takes the last of the range before, of which there is one row for each range and key in it. Events that tie in
    the order stay in one range, where either may be the earlier one. A null key is a key of its own.
    """
    part, image, carry = (fresh([*df.columns, "before", "after"], x) for x in ("_part", "_image", "_carry"))
    dealt = settled(df.withColumn(image, F.struct(*images)).repartitionByRange(*keys, *order).withColumn(part, F.spark_partition_id()))
    # ranges with events of one key follow each other, so all but a key's last range are full of it: few rows
    last = F.max(F.struct(F.struct(*order).alias("at"), F.col(image).alias("image")))["image"]
    ends = dealt.groupBy(*keys, part).agg(last.alias(carry))
    before = ends.withColumn(carry, F.lag(carry).over(Window.partitionBy(*keys).orderBy(part))).where(F.col(carry).isNotNull())
    named = before.select(*[F.col(k).alias(f"{k}_of") for k in keys], F.col(part).alias(f"{part}_of"), F.col(carry))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys], F.col(part) == F.col(f"{part}_of"))
    earlier = F.lag(image).over(Window.partitionBy(*keys, part).orderBy(*order))
    found = dealt.withColumn("before", earlier).join(named, same, "left")
    return found.select(*[F.col(c) for c in df.columns if c not in ("before", "after")], F.coalesce("before", carry).alias("before"), F.col(image).alias("after"))


def document_change(df: DataFrame) -> DataFrame:
    """Events of a document stream from operationType, id, coll, full, full_before (extended JSON texts).

    An update whose document is gone has {"_id": id} on that side; a delete has it as after, and before is the earlier
    image or null. A missing type, id or collection is an error.
    """
    known = F.when(F.col("operationType").isNull() | F.col("id").isNull() | F.col("coll").isNull(), fail("a change needs operationType, documentKey._id and ns.coll"))
    stub = F.concat(F.lit('{"_id":'), F.col("id"), F.lit("}"))
    op = known.otherwise(mapped_op(F.col("operationType"), DOCUMENT_OPS))
    after = F.when(F.col("op") == "d", stub).otherwise(F.coalesce(F.col("full"), F.when(F.col("op") == "u", stub).otherwise(fail("a new document is missing"))))
    return df.withColumn("op", op).select("coll", F.col("id").alias("key"), F.col("full_before").alias("before"), after.alias("after"), "op")


def item_change(df: DataFrame) -> DataFrame:
    """Events of a sharded item log from eventName, keys, old, new (maps) and created (timestamp)."""
    nothing = F.create_map().cast("map<string,string>")
    return df.select(
        F.col("keys").alias("key"), F.coalesce("old", nothing).alias("before"), F.coalesce("new", nothing).alias("after"),
        F.unix_millis("created").alias("ts_ms"), mapped_op(F.col("eventName"), LOG_OPS, "r").alias("op"),
    )


#: Wire type and semantic name by Spark type.
WIRE = {
    "boolean": ("boolean", ""), "smallint": ("int16", ""), "int": ("int32", ""), "bigint": ("int64", ""), "float": ("float", ""), "double": ("double", ""),
    "string": ("string", ""), "binary": ("bytes", ""), "date": ("int32", "io.debezium.time.Date"), "timestamp": ("string", "io.debezium.time.ZonedTimestamp"),
    "timestamp_ntz": ("int64", "io.debezium.time.MicroTimestamp"),
}


def field(name: str, kind: T.DataType) -> dict:
    """A column's entry in a schema block."""
    if isinstance(kind, T.DecimalType):
        return {"type": "bytes", "optional": False, "field": name, "name": "org.apache.kafka.connect.data.Decimal", "parameters": {"scale": str(kind.scale), "connect.decimal.precision": str(kind.precision)}}
    wire, semantic = WIRE.get(kind.simpleString(), ("struct" if isinstance(kind, T.StructType) else "map" if isinstance(kind, T.MapType) else "array", ""))
    return {"type": wire, "optional": False, "field": name, "name": semantic}


def schema_block(schema: T.StructType, sides: list[str]) -> str:
    """The schema part of a message, one block per side, as JSON text."""
    fields = [field(f.name, f.dataType) for f in schema]
    return json.dumps({"type": "", "fields": [{"fields": fields, "type": "struct", "optional": False, "field": side} for side in sides]}, separators=(",", ":"))


def message(events: DataFrame, topic: Column, key_schema: str = '{"type":"","fields":null,"optional":false,"field":""}', value_schema: str = '{"type":"","fields":null}') -> DataFrame:
    """topic, key and value texts of a wire message: nulls kept, binary as base64, three signs escaped."""
    wrap = lambda block, payload: F.concat(F.lit(f'{{"schema":{block},"payload":'), escaped_json(F.to_json(payload, {"ignoreNullFields": "false"})), F.lit("}"))
    return events.select(topic.alias("topic"), wrap(key_schema, F.col("key")).alias("key"), wrap(value_schema, F.struct("before", "after", "source", "op")).alias("value"))
