"""Identifiers, names and document keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.numeric import fail

UUID = r"^(?:urn:uuid:)?\{?([0-9a-f]{8})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{12})\}?$"


def uuid(text: Column) -> Column:
    """Canonical lower-case form; an error for anything else."""
    low = F.lower(F.trim(text))
    return F.when(text.isNull(), F.lit(None)).when(low.rlike(UUID), F.regexp_replace(low, UUID, "$1-$2-$3-$4-$5")).otherwise(fail("not a UUID: ", text))


def mixed_endian_uuid(data: Column) -> Column:
    """A 16-byte identifier whose first three groups are little-endian."""
    h = F.hex(data)
    at = lambda *order: [F.substring(h, 2 * i + 1, 2) for i in order]
    groups = [F.concat(*at(3, 2, 1, 0)), F.concat(*at(5, 4)), F.concat(*at(7, 6)), F.concat(*at(8, 9)), F.concat(*at(10, 11, 12, 13, 14, 15))]
    return F.when(data.isNull(), F.lit(None)).when(F.length(data) == 16, F.lower(F.concat_ws("-", *groups))).otherwise(fail("a UUID has 16 bytes"))


def topic(prefix: str, *parts: Column) -> Column:
    """prefix.part.part; an empty prefix is left out."""
    return F.concat_ws(".", *([F.lit(prefix)] if prefix else []), *parts)


def document_key(kind: Column, value: Column) -> Column:
    """A document's key as text: objectId as {"$oid":"..."}, strings and whole numbers as they are, others as JSON."""
    return F.when(kind == "objectId", F.concat(F.lit('{"$oid":"'), value, F.lit('"}'))).otherwise(value)


def table_arn(stream_arn: Column) -> Column:
    """The table's name within a stream's resource name; an error if there is none."""
    return F.when(stream_arn.isNull(), F.lit(None)).when(stream_arn.contains("/stream/"), F.split(stream_arn, "/stream/")[0]).otherwise(fail("no stream in ", stream_arn))


def unescaped(name: str) -> str:
    """A name without its one pair of backquotes or double quotes."""
    return name[1:-1] if len(name) > 1 and name[0] == name[-1] and name[0] in "`\"" else name


def escaped_json(text: Column) -> Column:
    """JSON text with <, > and & as the escapes that the wire form has."""
    out = text
    for sign, code in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e")):
        out = F.replace(out, F.lit(sign), F.lit(code))
    return out
