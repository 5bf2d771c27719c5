"""Relational tables over JDBC, read in parallel by key ranges; catalogues and preflight checks by queries of each dialect."""

from __future__ import annotations

import datetime
import decimal
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import keyset
from tideline.operators.keyset import EmptyTable
from tideline.plans.config import SourceConfig, TableConfig
from tideline.plans.snapshot import SnapshotPlan
from tideline.sources.registry import source_of
from tideline.types import mssql, mysql, postgres
from tideline.types.kind import Kind

DRIVERS = {"mysql": "com.mysql.cj.jdbc.Driver", "postgresql": "org.postgresql.Driver", "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver", "derby": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}

KEY_QUERIES = {
    "mysql": "SELECT k.column_name FROM information_schema.table_constraints t JOIN information_schema.key_column_usage k USING (constraint_name, table_schema, table_name) "
    "WHERE t.constraint_type = 'PRIMARY KEY' AND t.table_schema = DATABASE() AND t.table_name = '{table}' ORDER BY k.ordinal_position",
    "postgresql": "SELECT a.attname AS column_name FROM pg_index i JOIN pg_attribute a ON a.attrelid = i.indrelid AND a.attnum = ANY(i.indkey) "
    "WHERE i.indisprimary AND i.indrelid = '{schema}.{table}'::regclass ORDER BY array_position(i.indkey, a.attnum)",
    "mssql": "SELECT k.COLUMN_NAME FROM INFORMATION_SCHEMA.KEY_COLUMN_USAGE k JOIN INFORMATION_SCHEMA.TABLE_CONSTRAINTS t ON k.CONSTRAINT_NAME = t.CONSTRAINT_NAME AND k.TABLE_SCHEMA = t.TABLE_SCHEMA "
    "AND k.TABLE_NAME = t.TABLE_NAME WHERE t.CONSTRAINT_TYPE = 'PRIMARY KEY' AND k.TABLE_SCHEMA = '{schema}' AND k.TABLE_NAME = '{table}' ORDER BY k.ORDINAL_POSITION",
}
COLUMN_QUERIES = {
    "mysql": "SELECT column_name, column_type FROM information_schema.columns WHERE table_schema = DATABASE() AND table_name = '{table}' ORDER BY ordinal_position",
    "postgresql": "SELECT c.column_name, c.data_type, c.numeric_precision, c.numeric_scale, c.character_maximum_length, c.udt_name, t.typelem FROM information_schema.columns c "
    "LEFT JOIN pg_catalog.pg_type t ON c.udt_name = t.typname WHERE c.table_schema = '{schema}' AND c.table_name = '{table}' ORDER BY c.ordinal_position",
    "mssql": "SELECT COLUMN_NAME, DATA_TYPE, NUMERIC_PRECISION, NUMERIC_SCALE, DATETIME_PRECISION FROM INFORMATION_SCHEMA.COLUMNS WHERE TABLE_SCHEMA = '{schema}' AND TABLE_NAME = '{table}' ORDER BY ORDINAL_POSITION",
}
TABLE_QUERY = "SELECT table_name FROM information_schema.tables WHERE table_type = 'BASE TABLE' AND table_schema = {schema}"
PARTS = 16  # key ranges of a read, unless the source's option `partitions` says otherwise
CREATE_QUERY = "SHOW CREATE TABLE {table}"


def quoted(kind: str, name: str) -> str:
    left, right = {"mysql": "``", "mssql": "[]"}.get(kind, '""')
    return left + name.replace(right, right * 2) + right


def options(source: SourceConfig) -> dict[str, str]:
    return {"url": source.options.get("url") or source.url, "driver": source.options.get("driver") or DRIVERS[source.kind], "user": source.user, "password": source.password, "fetchsize": "5000"}


def query(spark: SparkSession, source: SourceConfig, text: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options(source)).option("query", text).load()


def key_columns(spark: SparkSession, source: SourceConfig, table: TableConfig) -> list[str]:
    """Declared override, or the catalogue's key."""
    if table.keys:
        return list(table.keys)
    found = query(spark, source, KEY_QUERIES[source.kind].format(schema=table.schema, table=table.name)).collect()
    return [r[0] for r in found]


@dataclass(frozen=True)
class Split:
    """Key ranges of a read by a key of whole numbers, cut evenly between its bounds."""

    column: str
    low: int
    high: int
    parts: int

    def predicates(self) -> list[str]:
        """Ranges without gaps or overlaps; the first and last are open, so that no row outside the bounds is lost, and the
        first has the rows without a key, if keys are stated that can be null."""
        if self.parts < 2 or self.high <= self.low:
            return ["1=1"]
        width = -(-(self.high - self.low + 1) // self.parts)
        cuts = [c for c in (self.low + width * i for i in range(1, self.parts)) if c <= self.high]
        if not cuts:
            return ["1=1"]
        middle = [f"{self.column} >= {a} AND {self.column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
        return [f"({self.column} < {cuts[0]} OR {self.column} IS NULL)", *middle, f"{self.column} >= {cuts[-1]}"]


def literal(kind: str, value) -> str | None:
    """A key value in the database's SQL; None where its text may not mean the same value there."""
    if isinstance(value, decimal.Decimal) and value.is_finite():
        return format(value, "f")
    if isinstance(value, int) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, str) and "\\" not in value and "\0" not in value:  # what a backslash means is a setting of the server
        return ("N'" if kind == "mssql" else "'") + value.replace("'", "''") + "'"
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return f"'{value.isoformat()}'"
    return None


def _beyond(columns: list[str], cut: list[str]) -> str:
    """Tuples after the cut, without comparing tuples, which not every database can."""
    (column, *more), (value, *rest) = columns, cut
    return f"{column} > {value}" if not more else f"({column} >= {value} AND ({column} > {value} OR {_beyond(more, rest)}))"


def _upto(columns: list[str], cut: list[str]) -> str:
    (column, *more), (value, *rest) = columns, cut
    return f"{column} <= {value}" if not more else f"({column} <= {value} AND ({column} < {value} OR {_upto(more, rest)}))"


def tuple_ranges(columns: list[str], cuts: list[list[str]]) -> list[str]:
    """Ranges between ascending cuts that cover all rows once; rows with a null in their key are in the first."""
    if not cuts:
        return ["1=1"]
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    unknown = " OR ".join(f"{c} IS NULL" for c in columns)
    middle = [f"{known} AND {_beyond(columns, a)} AND {_upto(columns, b)}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"({unknown} OR {_upto(columns, cuts[0])})", *middle, f"{known} AND {_beyond(columns, cuts[-1])}"]


def cuts_of(spark: SparkSession, source: SourceConfig, table: TableConfig, keys: list[str], parts: int) -> list[list[str]]:
    """Key tuples that cut a table into parts of equally many rows. Each is found from the one before, in the database's
    own order, so that all queries together walk the key's index once; they end at a value that can't be stated."""
    columns = [quoted(source.kind, k) for k in keys]
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    total = query(spark, source, f"SELECT COUNT(*) AS n FROM {name_of(source, table)} WHERE {known}").first()[0]
    step = -(-total // max(1, parts))
    nth = f"LIMIT 1 OFFSET {step - 1}" if source.kind == "mysql" else f"OFFSET {step - 1} ROWS FETCH NEXT 1 ROWS ONLY"
    found: list[list[str]] = []
    while 0 < step < total and len(found) < parts - 1:
        rest = f"{known} AND {_beyond(columns, found[-1])}" if found else known
        row = query(spark, source, f"SELECT {', '.join(columns)} FROM {name_of(source, table)} WHERE {rest} ORDER BY {', '.join(columns)} {nth}").first()
        cut = [literal(source.kind, v) for v in row] if row else [None]
        if None in cut:
            break
        found.append(cut)
    return found


def name_of(source: SourceConfig, table: TableConfig) -> str:
    return ".".join(quoted(source.kind, x) for x in (table.schema, table.name) if x)


def bounds_of(spark: SparkSession, source: SourceConfig, table: TableConfig, key: str) -> tuple:
    column = quoted(source.kind, key)
    row = query(spark, source, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {name_of(source, table)}").first()
    if row is None or row[0] is None:
        raise EmptyTable(table.name)
    return row[0], row[1]


def scan(spark: SparkSession, source: SourceConfig, table: TableConfig, parts: int | None = None) -> DataFrame:
    """The whole table by ranges of its key; filters and column choice of later steps are pushed into each range.

    A key of one whole number is cut evenly between its bounds; any other, as texts and composite keys, at tuples that
    the database finds, so that a first column of few values still gives even ranges.
    """
    keys = key_columns(spark, source, table)
    if not keys:
        raise ValueError(f"{table.name} has no primary key")
    settings, parts = options(source), parts or int(source.options.get("partitions") or PARTS)
    try:
        low, high = bounds_of(spark, source, table, keys[0])
    except EmptyTable:
        return spark.read.format("jdbc").options(**settings).option("dbtable", name_of(source, table)).load()
    columns = [quoted(source.kind, k) for k in keys]
    whole = len(keys) == 1 and isinstance(low, int) and not isinstance(low, bool)
    ranges = Split(columns[0], low, high, parts).predicates() if whole else tuple_ranges(columns, cuts_of(spark, source, table, keys, parts))
    properties = {k: v for k, v in settings.items() if k != "url"}
    return spark.read.jdbc(settings["url"], name_of(source, table), predicates=ranges, properties=properties)


@source_of("mysql", "postgresql", "mssql", "derby")
def read(spark: SparkSession, source: SourceConfig, table: TableConfig) -> DataFrame:
    return scan(spark, source, table)


def list_tables(spark: SparkSession, source: SourceConfig, schema: str) -> list[str]:
    return sorted(r[0] for r in query(spark, source, TABLE_QUERY.format(schema="'" + schema.replace("'", "''") + "'")).collect())


class PreflightError(ValueError):
    pass


def check_streaming(variables: dict[str, str]) -> list[str]:
    """Modes of a server that can be streamed from, or what is wrong with it."""
    low = {k.lower(): str(v).upper() for k, v in variables.items()}
    if low.get("binlog_format") != "ROW":
        raise PreflightError("binlog_format must be ROW")
    return [m for m in low.get("sql_mode", "").split(",") if m]


def uses_gtid(variables: dict[str, str]) -> bool:
    low = {k.lower(): str(v).upper() for k, v in variables.items()}
    return low.get("gtid_mode") == "ON" and low.get("enforce_gtid_consistency") == "ON"


def tagged(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns with their declared type in the field's metadata."""
    return df.select(*[F.col(c).alias(c, metadata={"declared": kinds[c]}) if c in kinds else F.col(c) for c in df.columns])


def kinds_of(source_kind: str, rows: list[tuple], sql_mode: list[str] | None = None) -> dict[str, Kind]:
    """Kinds by column from the rows of a catalogue query; columns that can't be read are left out."""
    if source_kind == "mysql":
        return {name: mysql.parse(declared, sql_mode or ()) for name, declared in rows}
    if source_kind == "postgresql":
        return {
            name: postgres.parse(kind, precision, scale, length, udt)
            for name, kind, precision, scale, length, udt, *_ in rows
            if kind not in postgres.DROPPED and udt not in postgres.DROPPED
        }
    if source_kind == "mssql":
        return {name: mssql.parse(kind, precision, scale, digits) for name, kind, precision, scale, digits in rows}
    raise ValueError(f"no types of {source_kind}")


def check_keys(source_kind: str, keys: list[str], declared: dict[str, str]) -> None:
    """An error for a key whose type can't be one."""
    if not keys:
        raise ValueError("no primary key")
    if source_kind == "postgresql" and (bad := [k for k in keys if declared.get(k) not in postgres.KEYS]):
        raise ValueError(f"type can't be a key: {', '.join(f'{k} {declared.get(k)}' for k in bad)}")


def load_plan(spark: SparkSession, source: SourceConfig, table: TableConfig, sql_mode: list[str] | None = None) -> SnapshotPlan:
    """Columns, types, keys and range of a table, from its catalogue and its settings."""
    rows = [tuple(r) for r in query(spark, source, COLUMN_QUERIES[source.kind].format(schema=table.schema, table=table.name)).collect()]
    keys = key_columns(spark, source, table)
    check_keys(source.kind, keys, {r[0]: r[1] for r in rows})
    kinds = kinds_of(source.kind, rows, sql_mode)
    return plan_of(table, keys, kinds, tuple(r[0] for r in rows if r[0] not in kinds))


def plan_of(table: TableConfig, keys: list[str], kinds: dict[str, Kind], left_out: tuple[str, ...] = ()) -> SnapshotPlan:
    names = [kinds[k].name if k in kinds else "text" for k in keys]
    start, end = (keyset.overrides(keys, names, x) for x in (table.start, table.end))
    return SnapshotPlan(table.name, tuple(keys), kinds, table.choice, start, end, left_out)


def create_statement(spark: SparkSession, source: SourceConfig, name: str) -> str:
    """A table's own CREATE statement, to begin a schema history with."""
    return query(spark, source, CREATE_QUERY.format(table=quoted(source.kind, name))).first()[1]
