"""SQL Server: declared type and its precision to Kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions import numeric, temporal
from tideline.types.kind import Kind, UnknownType

TEXTS = {"char", "varchar", "nchar", "nvarchar", "text", "ntext", "xml"}
BLOBS = {"image", "binary", "varbinary"}


def _by_digits(digits: int) -> int:
    """0: milliseconds, 1: microseconds, 2: nanoseconds."""
    return 0 if digits <= 3 else 1 if digits <= 6 else 2


def parse(declared: str, precision: int | None = None, scale: int | None = None, datetime_precision: int | None = None) -> Kind:
    if declared == "bit":
        return Kind("bit", "boolean", "boolean", lambda c: c.cast("boolean"))
    if declared in ("tinyint", "smallint"):
        return Kind("smallint", "smallint", "int16", lambda c: numeric.integer(c, "smallint"))
    if declared in ("int", "bigint"):
        return Kind(declared, declared, "int32" if declared == "int" else "int64", lambda c: numeric.integer(c, declared))
    if declared in ("float", "real"):
        return Kind("float", "double", "double", lambda c: c.cast("double"))
    if declared in ("numeric", "decimal"):
        p, s = precision or 18, scale or 0
        return Kind("numeric", f"decimal({p},{s})", "bytes", lambda c: numeric.decimal_bytes(c, p, s), precision=p, scale=s)
    if declared in ("money", "smallmoney"):
        return Kind("money", "decimal(19,4)", "bytes", lambda c: numeric.decimal_bytes(numeric.money(c, 4), 19, 4), precision=19, scale=4)
    if declared == "time":
        unit = _by_digits(7 if datetime_precision is None else datetime_precision)
        return Kind("time", ("int", "bigint", "bigint")[unit], ("int32", "int64", "int64")[unit], (temporal.time_millis, temporal.time_micros, temporal.time_nanos)[unit])
    if declared == "date":
        return Kind("date", "date", "int32", temporal.epoch_days)
    if declared in ("smalldatetime", "datetime", "datetime2"):
        unit = _by_digits((7 if datetime_precision is None else datetime_precision) if declared == "datetime2" else 3)
        return Kind(declared, "timestamp_ntz", "int64", (temporal.epoch_millis, temporal.epoch_micros, temporal.epoch_nanos)[unit])
    if declared == "datetimeoffset":
        return Kind("datetimeoffset", "timestamp", "string", temporal.zoned_text)
    if declared in TEXTS:
        return Kind("text", "string", "string")
    if declared == "uniqueidentifier":
        return Kind("uuid", "string", "string", F.lower)
    if declared in BLOBS:
        return Kind("binary", "binary", "bytes")
    raise UnknownType(f"unknown type: {declared!r}")
