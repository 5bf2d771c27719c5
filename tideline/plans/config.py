"""Settings: one source, one sink, tables with their columns and key ranges. Read from YAML where it is installed, or from a dict."""

from __future__ import annotations

from dataclasses import dataclass, field

from tideline.operators.projection import ColumnChoice

SOURCES = ("dynamodb", "mongodb", "mssql", "mysql", "postgresql")
SINKS = ("kafka", "table")
BEFORE_BACKFILL = ("none", "truncate", "drop")
AUTH = ("none", "scram-sha-512", "aws-msk-iam")


class ConfigError(ValueError):
    pass


def _need(found: dict, *names: str) -> None:
    if missing := [n for n in names if found.get(n) in (None, "")]:
        raise ConfigError(f"missing: {', '.join(missing)}")


@dataclass(frozen=True)
class TableConfig:
    name: str
    schema: str = ""
    batch_size: int = 5_000
    choice: ColumnChoice = ColumnChoice()
    start: str | list[str] | None = None
    end: str | list[str] | None = None
    keys: tuple[str, ...] = ()

    @classmethod
    def of(cls, given: dict, schema: str = "") -> TableConfig:
        _need(given, "name")
        if given.get("excludeColumns") and given.get("includeColumns"):
            raise ConfigError(f"{given['name']}: columns can be excluded or included, not both")
        choice = ColumnChoice(tuple(given.get("excludeColumns", ())), tuple(given.get("includeColumns", ())))
        size = int(given.get("batchSize") or 5_000)
        if size < 1:
            raise ConfigError(f"{given['name']}: batchSize must be positive")
        return cls(given["name"], given.get("schema", schema), size, choice, given.get("optionalPrimaryKeyValStart"), given.get("optionalPrimaryKeyValEnd"), tuple(given.get("primaryKeysOverride", ())))


@dataclass(frozen=True)
class SourceConfig:
    kind: str
    host: str = ""
    port: int = 0
    user: str = ""
    password: str = ""
    database: str = ""
    tables: tuple[TableConfig, ...] = ()
    options: dict = field(default_factory=dict)

    @property
    def streaming(self) -> bool:
        return bool(self.options.get("streaming"))

    @property
    def url(self) -> str:
        """JDBC address, or that of a document store."""
        at = f"{self.host}:{self.port}"
        return {
            "mysql": f"jdbc:mysql://{at}/{self.database}",
            "postgresql": f"jdbc:postgresql://{at}/{self.database}" + ("?sslmode=disable" if self.options.get("disableSSL") else ""),
            "mssql": f"jdbc:sqlserver://{at};databaseName={self.database}",
            "mongodb": self.host if self.host.startswith("mongodb") else f"mongodb://{at}",
        }.get(self.kind, "")


@dataclass(frozen=True)
class SinkConfig:
    kind: str
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Settings:
    source: SourceConfig
    sink: SinkConfig


DEFAULT_SCHEMA = {"postgresql": "public", "mssql": "dbo"}


def _source(kind: str, given: dict) -> SourceConfig:
    if kind == "dynamodb":
        _need(given, "tableName", "awsRegion")
        snapshot = bool(given.get("snapshot"))
        if snapshot:
            _need(given.get("snapshotSettings") or {}, "s3Bucket", "folder")
        else:
            _need(given, "streamArn", "offsetFile")
        return SourceConfig(kind, tables=(TableConfig(given["tableName"]),), options={**given, "streaming": not snapshot})
    if kind == "mongodb":
        _need(given, "host", "database")
        tables = tuple(TableConfig.of(t) for t in given.get("collections", ()))
        if (given.get("streamingSettings") or {}).get("enabled"):
            _need(given["streamingSettings"], "offsetFile")
    else:
        _need(given, "host", "port", "username", "password", "database")
        if not 1 <= int(given["port"]) <= 65_535:
            raise ConfigError(f"port out of range: {given['port']}")
        tables = tuple(TableConfig.of(t, DEFAULT_SCHEMA.get(kind, "")) for t in given.get("tables", ()))
        if kind == "mysql" and (given.get("streamingSettings") or {}).get("enabled"):
            _need(given["streamingSettings"], "offsetFile", "schemaHistoryFile")
    if not tables:
        raise ConfigError("no tables")
    streaming = (given.get("streamingSettings") or {}).get("enabled", False)
    return SourceConfig(kind, given.get("host", ""), int(given.get("port") or 0), given.get("username", ""), given.get("password", ""), given.get("database", ""), tables, {**given, "streaming": streaming})


def settings(given: dict) -> Settings:
    """Checked settings of a dict; the source is dynamodb and the sink kafka unless stated."""
    kind = given.get("source") or "dynamodb"
    if kind not in SOURCES:
        raise ConfigError(f"unknown source: {kind}")
    if not given.get(kind):
        raise ConfigError(f"no settings of {kind}")
    source = _source(kind, given[kind])
    sink = given.get("destination") or "kafka"
    if sink not in SINKS:
        raise ConfigError(f"unknown destination: {sink}")
    options = given.get(sink) or {}
    if sink == "kafka":
        _need(options, "bootstrapServers", "topicPrefix")
        if options.get("authMechanism", "none") not in AUTH:
            raise ConfigError(f"unknown authMechanism: {options['authMechanism']}")
    else:
        if options.get("beforeBackfill", "none") not in BEFORE_BACKFILL:
            raise ConfigError(f"unknown beforeBackfill: {options['beforeBackfill']}")
        if len(source.tables) > 1 and not options.get("severalTables"):
            raise ConfigError("a table sink takes one table a run, unless severalTables is set")
    return Settings(source, SinkConfig(sink, options))


def read(text: str) -> Settings:
    import yaml

    return settings(yaml.safe_load(text))
