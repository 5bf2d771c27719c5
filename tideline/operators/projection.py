"""Column choice and row filters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statements of a log that carry no schema change.
NOISE = (
    r"^(BEGIN|COMMIT)$",
    r"DROP TEMPORARY TABLE IF EXISTS .+ /\* generated by server \*/",
    r"(SET STATEMENT .*)?INSERT INTO (mysql\.)?rds_heartbeat2\(.*\) values \(.*\) ON DUPLICATE KEY UPDATE value = .*",
    r"(SET STATEMENT .*)?DELETE FROM (mysql\.)?rds_sysinfo.*",
    r"(SET STATEMENT .*)?INSERT INTO (mysql\.)?rds_sysinfo\(.*\) values \(.*\)",
    r"(SET STATEMENT .*)?INSERT INTO (mysql\.)?rds_monitor\(.*\) values \(.*\) ON DUPLICATE KEY UPDATE value = .*",
    r"(SET STATEMENT .*)?INSERT INTO (mysql\.)?rds_monitor\(.*\) values \(.*\)",
    r"(SET STATEMENT .*)?DELETE FROM (mysql\.)?rds_monitor.*",
    r"FLUSH RELAY LOGS.*",
    r"flush relay logs.*",
    r"SAVEPOINT .*",
    r"^\s*#\s*Dummy event.*",
)


class ColumnError(ValueError):
    pass


def by_names(columns: list[str], names: list[str]) -> list[str]:
    """The names, all of which must be columns."""
    if missing := [n for n in names if n not in columns]:
        raise ColumnError(f"no such column: {', '.join(missing)}")
    return list(names)


def exclude(columns: list[str], names: list[str], keys: list[str]) -> list[str]:
    """Columns without the names; a key can't be left out, an empty list leaves all."""
    if lost := [k for k in keys if k in names]:
        raise ColumnError(f"key column can't be excluded: {', '.join(lost)}")
    return [c for c in columns if c not in names]


def include(columns: list[str], names: list[str], keys: list[str]) -> list[str]:
    """Columns among the names, in the table's order; all keys must be named, an empty list takes all."""
    if not names:
        return list(columns)
    by_names(columns, names)
    if lost := [k for k in keys if k not in names]:
        raise ColumnError(f"key column must be included: {', '.join(lost)}")
    return [c for c in columns if c in names]


@dataclass(frozen=True)
class ColumnChoice:
    """Excluded or included columns of a table; excluding comes first, and both at once are an error."""

    excluded: tuple[str, ...] = ()
    included: tuple[str, ...] = ()

    def __post_init__(self):
        if self.excluded and self.included:
            raise ColumnError("columns can be excluded or included, not both")

    def of(self, columns: list[str], keys: list[str]) -> list[str]:
        return include(exclude(columns, list(self.excluded), keys), list(self.included), keys)


def project(df: DataFrame, choice: ColumnChoice, keys: list[str]) -> DataFrame:
    return df.select(*choice.of(df.columns, keys))


def as_json_text(column: Column) -> Column:
    """An array column as JSON text."""
    return F.to_json(column)


def is_noise(statement: Column) -> Column:
    return F.coalesce(statement.rlike("|".join(f"(?:{p})" for p in NOISE)), F.lit(False))


def of_database(database: Column, name: str) -> Column:
    return F.lower(database) == name.lower()


def watched(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Rows whose name is configured; a handful of names folds into the scan's filter."""
    return df.where(F.col(column).isin(names))


IGNORED = ("format_description", "anonymous_gtid", "previous_gtids", "table_map", "xid", "rows_query", "heartbeat")
ROWS = {"write_rows": "c", "update_rows": "u", "delete_rows": "d"}


def routed(kind: Column) -> Column:
    """Where an event of a log goes: ignore, position, ddl, dml or log."""
    return (
        F.when(kind.isin(*IGNORED), "ignore").when(kind.isin("rotate", "gtid"), "position").when(kind == "query", "ddl").when(kind.isin(*ROWS), "dml").otherwise("log")
    )


def zipped(names: Column, values: Column) -> Column:
    """A map of column names to values; an error if their numbers differ."""
    same = F.size(names) == F.size(values)
    return F.when(same, F.map_from_arrays(names, values)).otherwise(F.raise_error(F.lit("row and columns differ in number")))
