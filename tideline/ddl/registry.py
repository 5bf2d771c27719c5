"""Schemas by table and time: immutable versions, folded from events.

A statement either applies whole or not at all: events are folded into a copy, which takes the registry's place at the end.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from tideline.ddl import events as E
from tideline.ddl.parser import parse
from tideline.operators.projection import ColumnChoice
from tideline.types import mysql


class SchemaError(ValueError):
    pass


@dataclass(frozen=True)
class TableVersion:
    name: str
    columns: tuple[E.ColumnDef, ...]
    since: int

    def index(self, column: str) -> int:
        for i, c in enumerate(self.columns):
            if c.name == column:
                return i
        raise SchemaError(f"column not found: {column!r}")

    @property
    def keys(self) -> list[str]:
        return [c.name for c in self.columns if c.primary_key]

    def typed(self, choice: ColumnChoice = ColumnChoice(), sql_mode: Iterable[str] = ()) -> list[tuple[str, mysql.Kind]]:
        """Parsed types of the chosen columns; types of others aren't looked at."""
        by_name = {c.name: c for c in self.columns}
        return [(n, mysql.parse(by_name[n].type, sql_mode)) for n in choice.of([c.name for c in self.columns], self.keys)]


def _placed(columns: tuple, column: E.ColumnDef, at: int | None) -> tuple:
    """The columns with one added, or with that at index `at` replaced, at its stated position."""
    rest = list(columns) if at is None else [*columns[:at], *columns[at + 1 :]]
    place = len(rest) if at is None else at
    if isinstance(column.position, E.First):
        place = 0
    elif isinstance(column.position, E.After):
        names = [c.name for c in rest]
        if column.position.column not in names:
            raise SchemaError(f"column not found: {column.position.column!r}")
        place = names.index(column.position.column) + 1
    rest.insert(place, replace(column, position=None, previous_name=""))
    return tuple(rest)


@dataclass(frozen=True)
class Registry:
    tables: dict[str, TableVersion] = field(default_factory=dict)

    def table(self, name: str) -> TableVersion:
        if name not in self.tables:
            raise SchemaError(f"table not found: {name!r}")
        return self.tables[name]

    def _event(self, event: E.Event, since: int) -> Registry:
        if isinstance(event, E.CreateTable):
            columns = tuple(replace(c, position=None) for c in event.columns)
            return Registry({**self.tables, event.table: TableVersion(event.table, columns, since)})
        if isinstance(event, E.CopyTable):
            return Registry({**self.tables, event.table: TableVersion(event.table, self.table(event.like).columns, since)})
        if isinstance(event, E.DropTable):
            return Registry({n: t for n, t in self.tables.items() if n != event.table})
        old = self.table(event.table)
        if isinstance(event, E.RenameTable):
            rest = {n: t for n, t in self.tables.items() if n != event.table}
            return Registry({**rest, event.new_name: TableVersion(event.new_name, old.columns, since)})
        columns = old.columns
        if isinstance(event, E.AddColumns):
            for c in event.columns:
                if c.name in {x.name for x in columns}:
                    raise SchemaError(f"column already exists: {c.name!r}")
                columns = _placed(columns, c, None)
        elif isinstance(event, E.ModifyColumn):
            c = event.column
            at = old.index(c.previous_name or c.name)
            was = columns[at]
            columns = _placed(columns, replace(c, type=c.type or was.type, primary_key=c.primary_key or was.primary_key), at)
        elif isinstance(event, E.SetDefault):
            at = old.index(event.column)
            columns = (*columns[:at], replace(columns[at], default=event.default), *columns[at + 1 :])
        elif isinstance(event, E.DropColumn):
            at = old.index(event.column)
            columns = (*columns[:at], *columns[at + 1 :])
        elif isinstance(event, E.RenameColumn):
            at = old.index(event.old)
            columns = (*columns[:at], replace(columns[at], name=event.new), *columns[at + 1 :])
        elif isinstance(event, E.AddPrimaryKey):
            for n in event.columns:
                old.index(n)
            columns = tuple(replace(c, primary_key=c.primary_key or c.name in event.columns) for c in columns)
        elif isinstance(event, E.DropPrimaryKey):
            columns = tuple(replace(c, primary_key=False) for c in columns)
        return Registry({**self.tables, event.table: TableVersion(event.table, columns, since)})

    def apply(self, statement: str, since: int) -> Registry:
        out = self
        for event in parse(statement):
            out = out._event(event, since)
        return out


def replay(history: Iterable[dict]) -> Registry:
    """The registry that a history of {"query", "unixTs"} entries makes."""
    out = Registry()
    for entry in history:
        out = out.apply(entry["query"], entry["unixTs"])
    return out


def recover(history: list[dict], offset_ts: int | None) -> Registry:
    """Replay at a start; a history that is newer than the offset that it belongs to is an error."""
    if offset_ts is not None and any(h["unixTs"] > offset_ts for h in history):
        raise SchemaError("the schema history is newer than the offset")
    return replay(history)


def bootstrap(registry: Registry, tables: list[str], create_statement, since: int) -> tuple[Registry, list[dict]]:
    """Tables that the registry lacks, from their CREATE statement; also the entries to append to the history."""
    added = []
    for name in tables:
        if name not in registry.tables:
            query = create_statement(name)
            registry = registry.apply(query, since)
            added.append({"query": query, "unixTs": since})
    return registry, added


def versions(history: Iterable[dict]) -> list[dict]:
    """One row per table version: table, since, and its columns as JSON; the input of joins by time."""
    out, known = [], Registry()
    for entry in history:
        later = known.apply(entry["query"], entry["unixTs"])
        for name, version in later.tables.items():
            if known.tables.get(name) != version:
                out.append({"table": name, "since": version.since, "columns": json.dumps([[c.name, c.type, c.primary_key] for c in version.columns])})
        known = later
    return out
