"""What data definition statements say, as values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class First:
    """Ahead of all columns."""


@dataclass(frozen=True)
class After:
    column: str


@dataclass(frozen=True)
class ColumnDef:
    name: str
    type: str = ""
    default: str | None = None
    primary_key: bool = False
    position: First | After | None = None
    previous_name: str = ""


@dataclass(frozen=True)
class Event:
    table: str


@dataclass(frozen=True)
class CreateTable(Event):
    columns: tuple[ColumnDef, ...]


@dataclass(frozen=True)
class CopyTable(Event):
    like: str


@dataclass(frozen=True)
class DropTable(Event):
    pass


@dataclass(frozen=True)
class RenameTable(Event):
    new_name: str
    by_alter: bool = False


@dataclass(frozen=True)
class AddColumns(Event):
    columns: tuple[ColumnDef, ...]


@dataclass(frozen=True)
class ModifyColumn(Event):
    column: ColumnDef


@dataclass(frozen=True)
class SetDefault(Event):
    column: str
    default: str | None


@dataclass(frozen=True)
class DropColumn(Event):
    column: str


@dataclass(frozen=True)
class RenameColumn(Event):
    old: str
    new: str


@dataclass(frozen=True)
class AddPrimaryKey(Event):
    columns: tuple[str, ...]


@dataclass(frozen=True)
class DropPrimaryKey(Event):
    pass
