"""MySQL: declared type text to Kind."""

from __future__ import annotations

import re
from collections.abc import Iterable

from tideline.functions import bits, collections, geo, numeric, temporal
from tideline.types.kind import Kind, UnknownType

_ANNOTATION = re.compile(r"\s+(?:collate|character\s+set|charset)\s+.*$", re.IGNORECASE | re.DOTALL)

#: name: (signed, unsigned) with the Spark type of each
INTEGERS = {
    "tinyint": (("tinyint", "smallint"), ("smallint", "smallint")),
    "smallint": (("smallint", "smallint"), ("int", "int")),
    "mediumint": (("mediumint", "int"), ("int", "int")),
    "int": (("int", "int"), ("bigint", "bigint")),
    "integer": (("int", "int"), ("bigint", "bigint")),
    "bigint": (("bigint", "bigint"), ("bigint", "bigint")),
}
TEXTS = {"char", "varchar", "text", "tinytext", "mediumtext", "longtext"}
BLOBS = {"binary", "varbinary", "blob", "tinyblob", "mediumblob", "longblob"}
GEOMETRIES = {"geometry", "linestring", "polygon", "multipoint", "multilinestring", "multipolygon", "geomcollection", "geometrycollection"}


def parse(declared: str, sql_mode: Iterable[str] = (), exact_unsigned: bool = False, enum_base: int = 0) -> Kind:
    """Kind of a declared type; exact_unsigned keeps unsigned bigint whole as decimal(20,0)."""
    bare = _ANNOTATION.sub("", declared.strip())
    low = bare.lower()
    unsigned = bool(re.search(r"\s+unsigned\b", low))
    low = re.sub(r"\s+(?:unsigned|signed|zerofill)\b", "", low).strip()
    name, _, rest = low.partition("(")
    name, rest = name.strip(), rest.rpartition(")")[0]
    if name in ("boolean", "bool"):
        return Kind("tinyint", "smallint", "int16", lambda c: numeric.integer(c, "smallint"))
    if name in INTEGERS:
        if name == "bigint" and unsigned and exact_unsigned:
            return Kind("bigint unsigned", "decimal(20,0)", "bytes", precision=20, scale=0)
        kind, spark = INTEGERS[name][unsigned]
        return Kind(kind, spark, {"smallint": "int16", "int": "int32", "bigint": "int64"}[spark], lambda c: numeric.integer(c, spark))
    if name in ("decimal", "numeric"):
        if not re.fullmatch(r"\s*\d+\s*,\s*\d+\s*", rest):
            raise UnknownType(f"a decimal needs precision and scale: {declared!r}")
        p, s = map(int, rest.split(","))
        if p > 38:
            return Kind("decimal", "string", "bytes", numeric.variable_numeric, precision=p, scale=s)
        return Kind("decimal", f"decimal({p},{s})", "bytes", lambda c: numeric.decimal_bytes(c, p, s), precision=p, scale=s)
    if name == "float" or name == "real" and "REAL_AS_FLOAT" in sql_mode:
        return Kind("float", "float", "float", numeric.float32)
    if name in ("double", "real", "double precision"):
        return Kind("double", "double", "double", lambda c: c.cast("double"))
    if name == "bit":
        size = int(rest or 1)
        return Kind("bit", "boolean" if size == 1 else "binary", "boolean" if size == 1 else "bytes", lambda c: bits.bit_bytes(c, size), size=size)
    if name == "date":
        return Kind("date", "date", "int32", temporal.guarded_date)
    if name == "datetime":
        return Kind("datetime", "timestamp_ntz", "int64", lambda c: temporal.epoch_micros(temporal.zero_date_guard(c).cast("timestamp_ntz")))
    if name == "timestamp":
        return Kind("timestamp", "timestamp", "string", temporal.zoned_text)
    if name == "time":
        return Kind("time", "bigint", "int64", temporal.clock_micros)
    if name == "year":
        return Kind("year", "int", "int32", temporal.year_number)
    if name in TEXTS:
        return Kind(name, "string", "string")
    if name in BLOBS:
        return Kind(name, "binary", "bytes")
    if name in ("enum", "set"):
        # the values come from the original text, so that their case is kept
        values = tuple(collections.quoted_values(bare[bare.index("(") :]))
        labels = list(values)
        convert = (lambda c: collections.enum_label(c, labels, enum_base)) if name == "enum" else (lambda c: collections.set_labels(c, labels))
        return Kind(name, "string", "string", convert, values=values)
    if name == "json":
        return Kind("json", "string", "string")
    if name == "point":
        return Kind("point", "struct<x: double, y: double>", "struct", geo.binary_point)
    if name in GEOMETRIES:
        return Kind("geometry", "struct<wkb: binary, srid: int>", "struct", geo.binary_geometry)
    raise UnknownType(f"unknown type: {declared!r}")


