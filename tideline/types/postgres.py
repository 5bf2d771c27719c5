"""PostgreSQL: declared type and its modifiers to Kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions import bits, collections, geo, numeric, temporal, text
from tideline.types.kind import Kind, UnknownType

TEXTS = {"character varying", "text", "character", "xml", "cidr", "inet", "macaddr", "macaddr8", "int4range", "int8range", "numrange", "daterange", "tsrange", "tstzrange"}
DROPPED = {"tsvector"}
#: Types of a column that can be a key.
KEYS = {
    "boolean", "smallint", "integer", "bigint", "oid", "real", "double precision", "numeric", "money", "bit", "bytea", "character varying", "text", "character",
    "uuid", "date", "time without time zone", "timestamp without time zone", "timestamp with time zone", "interval",
}


def parse(declared: str, precision: int | None = None, scale: int | None = None, length: int | None = None, udt: str = "") -> Kind:
    if declared in ("bit", "bit varying"):
        size = length or (1 if declared == "bit" else 0)
        flag = declared == "bit" and size == 1
        convert = (lambda c: bits.bit(c, size)) if declared == "bit" else (lambda c: bits.bit_varying(c, size))
        return Kind(declared, "boolean" if flag else "binary", "boolean" if flag else "bytes", convert, size=size)
    if declared == "boolean":
        return Kind("boolean", "boolean", "boolean")
    if declared in ("smallint", "integer", "bigint", "oid"):
        spark = {"smallint": "smallint", "integer": "int"}.get(declared, "bigint")
        return Kind(declared, spark, {"smallint": "int16", "int": "int32", "bigint": "int64"}[spark], lambda c: numeric.integer(c, spark))
    if declared == "real":
        return Kind("real", "float", "float", numeric.float32)
    if declared == "double precision":
        return Kind("double", "double", "double", lambda c: c.cast("double"))
    if declared == "numeric":
        if precision is None:
            return Kind("variable numeric", "struct<scale: int, value: binary>", "struct", numeric.variable_numeric)
        if precision > 38:
            return Kind("numeric", "string", "bytes", numeric.variable_numeric, precision=precision, scale=scale or 0)
        return Kind("numeric", f"decimal({precision},{scale or 0})", "bytes", lambda c: numeric.decimal_bytes(numeric.decimal(c, precision, scale or 0), precision, scale or 0), precision=precision, scale=scale or 0)
    if declared == "money":
        return Kind("money", "decimal(19,2)", "bytes", lambda c: numeric.decimal_bytes(numeric.money(c), 18, 2), precision=19, scale=2)
    if declared == "bytea":
        return Kind("bytea", "binary", "bytes")
    if declared in TEXTS:
        return Kind("text", "string", "string")
    if declared == "time without time zone":
        return Kind("time", "int", "int32", temporal.clock_millis)
    if declared == "time with time zone":
        return Kind("timetz", "string", "string", temporal.utc_clock)
    if declared == "date":
        return Kind("date", "date", "int32", temporal.epoch_days)
    if declared == "timestamp without time zone":
        return Kind("timestamp", "timestamp_ntz", "int64", temporal.epoch_micros)
    if declared == "timestamp with time zone":
        return Kind("timestamptz", "timestamp", "string", temporal.zoned_text)
    if declared == "interval":
        return Kind("interval", "bigint", "int64", lambda c: temporal.interval_micros(c["months"], c["days"], c["micros"]))
    if declared == "uuid":
        return Kind("uuid", "string", "string", text.uuid)
    if declared == "ARRAY":
        return Kind("array", "array<string>", "array", collections.json_texts)
    if declared in ("json", "jsonb"):
        return Kind("json", "string", "string")
    if declared == "point":
        return Kind("point", "struct<x: double, y: double>", "struct", geo.point)
    if declared == "USER-DEFINED":
        if udt == "hstore":
            return Kind("hstore", "map<string, string>", "map", collections.without_nulls)
        if udt in ("geometry", "geography"):
            return Kind(udt, "struct<wkb: string, srid: int>", "struct", geo.hex_geometry)
        return Kind("text", "string", "string")
    raise UnknownType(f"unknown type: {declared!r}")


def projected(name: str, kind: Kind):
    """A column as the source query reads it: arrays as JSON text."""
    return F.to_json(F.col(name)).alias(name) if kind.name == "array" else F.col(name)
