"""Sources by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.plans.config import SourceConfig, TableConfig

Source = Callable[[SparkSession, SourceConfig, TableConfig], DataFrame]
SOURCES: dict[str, Source] = {}


def source_of(*kinds: str):
    def put(f: Source) -> Source:
        SOURCES.update(dict.fromkeys(kinds, f))
        return f

    return put


def read(spark: SparkSession, source: SourceConfig, table: TableConfig) -> DataFrame:
    from tideline.sources import documents, items, jdbc  # noqa: F401  they register themselves

    if source.kind not in SOURCES:
        raise ValueError(f"no source of {source.kind}")
    return SOURCES[source.kind](spark, source, table)
