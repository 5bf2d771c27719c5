"""Enums, sets, maps, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.numeric import fail


def enum_label(index: Column, labels: list[str], base: int = 0) -> Column:
    """The label at an index that starts at base; an error beyond the list."""
    at = index.cast("int") - base
    return F.when(at.isNull(), F.lit(None)).when(at.between(0, len(labels) - 1), F.get(F.array(*map(F.lit, labels)), at)).otherwise(fail("enum index out of range: ", index.cast("string")))


def set_labels(mask: Column, labels: list[str]) -> Column:
    """Comma-joined labels of the bits that are set, bit i for label i; empty for 0."""
    given = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(x).alias("label")) for i, x in enumerate(labels)])
    chosen = F.filter(given, lambda x: F.getbit(mask.cast("bigint"), x["i"]) == 1)
    return F.when(mask.isNotNull(), F.array_join(F.transform(chosen, lambda x: x["label"]), ","))


def quoted_values(metadata: str) -> list[str]:
    """Values of an enum's or a set's declaration: single quotes, a doubled quote for one, commas allowed inside."""
    values, current, inside, i = [], [], False, 0
    while i < len(metadata):
        c = metadata[i]
        if inside and c == "'" and metadata[i + 1 : i + 2] == "'":
            current.append("'")
            i += 1
        elif c == "'":
            inside = not inside
            if not inside:
                values.append("".join(current))
                current = []
        elif inside:
            current.append(c)
        i += 1
    if inside:
        raise ValueError(f"unclosed quote in {metadata!r}")
    return values


def without_nulls(pairs: Column) -> Column:
    """A map without the keys whose value is null."""
    return F.map_filter(pairs, lambda _, v: v.isNotNull())


def json_texts(items: Column) -> Column:
    """Elements of a JSON array as texts: strings as they are, everything else as JSON."""
    parsed = F.from_json(items, "array<string>")
    return F.when(items.isNull(), F.lit(None)).when(parsed.isNull(), fail("not a JSON array: ", items)).otherwise(parsed)


def elements_as_json(items: Column) -> Column:
    """Elements of an array of structs, maps or arrays as JSON texts."""
    return F.transform(items, F.to_json)
