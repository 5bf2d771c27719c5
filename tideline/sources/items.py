"""Exports of a key-value store: gzip JSON lines of tagged items, and how an export's folder is found."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import tagged
from tideline.plans.config import SourceConfig, TableConfig
from tideline.sources.registry import source_of

MANIFEST = "manifest-summary.json"
LINE_BYTES = 1 << 20


def bucket_and_prefix(path: str) -> tuple[str, str]:
    """Parts of s3://bucket/prefix."""
    if not path.startswith("s3://"):
        raise ValueError(f"not an s3 path: {path}")
    bucket, _, prefix = path.removeprefix("s3://").partition("/")
    if not bucket or not prefix:
        raise ValueError(f"an s3 path needs a bucket and a prefix: {path}")
    return bucket, prefix


def data_folder(manifest: str) -> str:
    """Folder of the data files beside a manifest."""
    if not manifest.endswith(MANIFEST):
        raise ValueError(f"not a manifest: {manifest}")
    return manifest.removesuffix(MANIFEST) + "data/"


def find_export(exports: Iterable[dict], bucket: str, prefix: str) -> dict | None:
    """The first export of that place that hasn't failed."""
    for e in exports:
        if e["status"] != "FAILED" and e["bucket"] == bucket and e["prefix"] == prefix:
            return e
    return None


def await_export(start: Callable[[], dict], status: Callable[[dict], str], exports: Iterable[dict], bucket: str, prefix: str, sleep: Callable[[float], None], poll: float = 30.0) -> dict:
    """An export that has completed: a recent one, or a new one."""
    export = find_export(exports, bucket, prefix) or start()
    while (now := status(export)) != "COMPLETED":
        if now == "FAILED":
            raise RuntimeError(f"export failed: {export}")
        sleep(poll)
    return export


def scan(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Items of an export's files as JSON text; a gzip file is one task, so many files make many tasks."""
    lines = spark.read.text(paths).where(F.length("value") > 0)
    over = F.octet_length("value") > LINE_BYTES
    return lines.select(F.when(over, F.raise_error(F.lit("a line is longer than 1 MiB"))).otherwise(F.get_json_object("value", "$.Item")).alias("item"))


def snapshot(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Items as events with op r; a missing key is an error."""
    value = lambda k: F.coalesce(tagged.scalar(F.col("item"), k), F.raise_error(F.lit(f"no key {k}")).cast("string")).alias(k)
    return df.select(F.lit(table).alias("table"), F.struct(*map(value, keys)).alias("key"), tagged.decode(F.col("item")).alias("after"), tagged.schema(F.col("item")).alias("schema"), F.lit("r").alias("op"))


@source_of("dynamodb")
def read(spark: SparkSession, source: SourceConfig, table: TableConfig) -> DataFrame:
    files = source.options.get("files")
    return scan(spark, files or source.options["path"])
