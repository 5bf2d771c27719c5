"""Items of a key-value store whose every attribute carries its type as a tag."""

from __future__ import annotations

import base64
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TAGS = ("S", "N", "B", "BOOL", "NULL", "M", "L", "SS", "NS", "BS")
#: Logical type of each tag; NULL attributes have no entry in a schema.
KINDS = {"S": "string", "N": "float", "B": "bytes", "BOOL": "boolean", "M": "map", "L": "array", "SS": "array", "NS": "array", "BS": "array"}


def scalar(item: Column, attribute: str) -> Column:
    """One attribute's S, N or BOOL as text, by JSON functions alone."""
    return F.coalesce(*[F.get_json_object(item, f"$.{attribute}.{t}") for t in ("S", "N", "BOOL")])


def number(item: Column, attribute: str) -> Column:
    return F.get_json_object(item, f"$.{attribute}.N").cast("double")


def plain(value: dict):
    """The value of one tagged attribute; numbers are doubles, binary is checked base64."""
    if not isinstance(value, dict) or len(value) != 1:
        raise ValueError(f"not a tagged value: {value!r}")
    (tag, held), *_ = value.items()
    if tag in ("S", "BOOL"):
        return held
    if tag == "N":
        return float(held)
    if tag == "NULL":
        return None
    if tag == "B":
        return base64.b64encode(base64.b64decode(held, validate=True)).decode()
    if tag == "M":
        return {k: plain(v) for k, v in held.items()}
    if tag == "L":
        return [plain(v) for v in held]
    if tag == "SS":
        return list(held)
    if tag == "NS":
        return [float(v) for v in held]
    if tag == "BS":
        return [base64.b64encode(base64.b64decode(v, validate=True)).decode() for v in held]
    raise ValueError(f"unknown tag {tag!r}")


def decode_text(text: str | None) -> str | None:
    if text is None:
        return None
    return json.dumps({k: plain(v) for k, v in json.loads(text).items()}, separators=(",", ":"), sort_keys=True)


def schema_text(text: str | None) -> str | None:
    if text is None:
        return None
    return json.dumps({k: KINDS[next(iter(v))] for k, v in json.loads(text).items() if "NULL" not in v}, separators=(",", ":"), sort_keys=True)


def _mapped(one) -> callable:
    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(one, na_action="ignore")

    return run


def decode(item: Column) -> Column:
    """A whole item as plain JSON text. Nesting has no bound, so this is a batched Python function."""
    return _mapped(decode_text)(item)


def schema(item: Column) -> Column:
    """Logical type by attribute, as JSON text; attributes that are NULL are left out."""
    return _mapped(schema_text)(item)
