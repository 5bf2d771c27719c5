"""Bounded scans over composite primary keys.

A range scan is one predicate and one read; Spark splits it by files or by key ranges. `pages` reproduces a paged scan
for sources that can only be read so.
"""

from __future__ import annotations

import datetime
import decimal
import re
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_ROWS = 5_000


class EmptyTable(Exception):
    """The table has no rows, so its keys have no bounds."""


class StuckScan(Exception):
    """A page after the first began where the one before did."""


def _compare(keys: list[str], values: tuple, strictly, loosely_last: bool) -> Column:
    """Lexicographic comparison, expanded: (a, b) > (x, y) is a > x or a = x and b > y."""
    cases = []
    for i in range(len(keys)):
        same = [F.col(k) == F.lit(v) for k, v in zip(keys[:i], values[:i], strict=True)]
        cases.append(reduce(lambda a, b: a & b, same, strictly(F.col(keys[i]), F.lit(values[i]))))
    if loosely_last:
        cases.append(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in zip(keys, values, strict=True)]))
    # the plain bound of the first key is implied; stated, it reaches the scan as a pushed filter
    first = F.col(keys[0])
    bound = first >= F.lit(values[0]) if strictly is _gt else first <= F.lit(values[0])
    return bound & reduce(lambda a, b: a | b, cases)


def _gt(a: Column, b: Column) -> Column:
    return a > b


def _lt(a: Column, b: Column) -> Column:
    return a < b


def after(keys: list[str], values: tuple, inclusive: bool) -> Column:
    return _compare(keys, values, _gt, inclusive)


def up_to(keys: list[str], values: tuple) -> Column:
    return _compare(keys, values, _lt, True)


def between(keys: list[str], start: tuple | None, end: tuple | None) -> Column:
    """Both ends included; None: open."""
    parts = [after(keys, start, True)] if start is not None else []
    parts += [up_to(keys, end)] if end is not None else []
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def bounds(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: least and greatest key tuple (in tuple order, not column by column)."""
    whole = F.struct(*keys)
    row = df.agg(F.min(whole).alias("lo"), F.max(whole).alias("hi"))
    return row.select(*[F.col(f"lo.{k}").alias(f"min_{k}") for k in keys], *[F.col(f"hi.{k}").alias(f"max_{k}") for k in keys])


def fetch_bounds(df: DataFrame, keys: list[str]) -> tuple[tuple, tuple]:
    row = bounds(df, keys).first()
    if row is None or row[0] is None:
        raise EmptyTable(f"no key values in {', '.join(keys)}")
    return tuple(row[: len(keys)]), tuple(row[len(keys) :])


def page(df: DataFrame, keys: list[str], start: tuple, end: tuple, inclusive: bool, rows: int = PAGE_ROWS) -> DataFrame:
    """The next rows of a range in key order."""
    return df.where(after(keys, start, inclusive) & up_to(keys, end)).orderBy(*keys).limit(rows)


def _same(a: tuple, b: tuple) -> bool:
    return all(type(x) is type(y) and x == y for x, y in zip(a, b, strict=True))


def pages(df: DataFrame, keys: list[str], rows: int = PAGE_ROWS, start: tuple | None = None, end: tuple | None = None) -> Iterator[list[Row]]:
    """Pages of a range, each by its own query: the first from the start itself, later ones after the last row's key."""
    low, high = fetch_bounds(df, keys)
    at, high, first = start or low, end or high, True
    while first or not _same(at, high):
        found = page(df, keys, at, high, first, rows).collect()
        if not found:
            return
        last = tuple(found[-1][k] for k in keys)
        if not first and _same(last, at):
            raise StuckScan(f"no progress after {at}")
        yield found
        at, first = last, False


INTEGER_LIMITS = {"tinyint": 8, "smallint": 16, "int2": 16, "mediumint": 24, "int": 32, "integer": 32, "int4": 32, "bigint": 64, "int8": 64}
FLOATS = ("float", "double", "real", "double precision", "float4", "float8")
DECIMALS = ("numeric", "decimal")


def parse_override(kind: str, text: str):
    """A key value given as text, checked against its declared type."""
    kind = kind.lower()
    if kind in INTEGER_LIMITS:
        if not re.fullmatch(r"[+-]?\d+", text):
            raise ValueError(f"not a whole number: {text!r}")
        value, half = int(text), 1 << (INTEGER_LIMITS[kind] - 1)
        if not -half <= value < half:
            raise ValueError(f"{text} is out of range for {kind}")
        return value
    if kind == "year":
        if not re.fullmatch(r"\d{4}", text) or not 1901 <= int(text) <= 2155:
            raise ValueError(f"not a year: {text!r}")
        return int(text)
    if kind == "boolean":
        if text.lower() not in ("true", "false", "1", "0"):
            raise ValueError(f"not a boolean: {text!r}")
        return text.lower() in ("true", "1")
    if kind in FLOATS:
        return float(text)
    if kind in DECIMALS:
        if not re.fullmatch(r"[+-]?(\d+(\.\d*)?|\.\d+)", text):
            raise ValueError(f"not a decimal: {text!r}")
        return decimal.Decimal(text)
    if kind == "uuid":
        return str(uuid.UUID(text))
    if kind in ("date",):
        return datetime.date.fromisoformat(text)
    if kind in ("datetime", "timestamp", "timestamp without time zone", "timestamp with time zone", "timestamptz"):
        return datetime.datetime.fromisoformat(text)
    if kind in ("binary", "varbinary", "blob", "bit", "bytea"):
        raise ValueError(f"a {kind} key can't be given as text")
    return text


def overrides(keys: list[str], kinds: list[str], text: str | list[str] | None) -> tuple | None:
    """Key values from comma-separated text, or from a list where values have commas themselves; as many as keys."""
    if not text:
        return None
    parts = text.split(",") if isinstance(text, str) else list(text)
    if len(parts) != len(keys):
        raise ValueError(f"{len(keys)} key values are needed, not {len(parts)}")
    return tuple(parse_override(k, p.strip() if isinstance(text, str) else p) for k, p in zip(kinds, parts, strict=True))


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.sparkSession.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema]))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
