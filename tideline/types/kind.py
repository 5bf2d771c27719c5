"""A column's declared type, read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column


class UnknownType(ValueError):
    pass


@dataclass(frozen=True)
class Kind:
    """name: the source's own name of the type; spark: type of the typed view; convert: typed view to wire value."""

    name: str
    spark: str
    wire: str
    convert: Callable[[Column], Column] = field(compare=False, default=lambda c: c)
    size: int | None = None
    precision: int | None = None
    scale: int | None = None
    values: tuple[str, ...] = ()
