"""A table's snapshot as one lazy plan: scan, column choice, key range, conversion, envelope."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators import envelope, keyset
from tideline.operators.projection import ColumnChoice
from tideline.types.kind import Kind


@dataclass(frozen=True)
class SnapshotPlan:
    """What to read of a table and how; kinds are the declared types by column, left_out the columns that can't be read."""

    table: str
    keys: tuple[str, ...]
    kinds: dict[str, Kind] = field(default_factory=dict)
    choice: ColumnChoice = ColumnChoice()
    start: tuple | None = None
    end: tuple | None = None
    left_out: tuple[str, ...] = ()

    def rows(self, df: DataFrame) -> DataFrame:
        """The range's rows, chosen columns only."""
        chosen = self.choice.of([c for c in df.columns if c not in self.left_out], list(self.keys))
        return df.where(keyset.between(list(self.keys), self.start, self.end)).select(*chosen)

    def converted(self, columns: list[str]) -> dict[str, Column]:
        """Wire values; a null value is null whatever its converter."""
        known = [c for c in columns if c in self.kinds]
        return {c: F.when(F.col(c).isNotNull(), self.kinds[c].convert(F.col(c))) for c in known}

    def events(self, df: DataFrame, ts_ms: Column) -> DataFrame:
        rows = self.rows(df)
        return envelope.snapshot(rows, list(self.keys), self.table, ts_ms, self.converted(rows.columns))

    def messages(self, df: DataFrame, ts_ms: Column, prefix: str, suffix: str) -> DataFrame:
        name = F.lit(f"{prefix}.{suffix}" if prefix else suffix)
        return envelope.message(self.events(df, ts_ms), name)


def warehouse_columns(fields: list[dict], keys: list[str]) -> list[dict]:
    """Column kinds and key flags of a table to create, from a schema block's fields."""
    return [{"name": f["field"], "kind": f["name"] or f["type"], "key": f["field"] in keys} for f in fields]
