"""Document collections as extended JSON lines."""

from __future__ import annotations

import decimal
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.plans.config import SourceConfig, TableConfig
from tideline.sources.registry import source_of


def id_text(document):
    """The _id as canonical extended JSON."""
    return F.get_json_object(document, "$._id")


def key_text(document):
    """A document's key: {"$oid":...} for object ids, whole numbers and strings bare, others as JSON."""
    raw = id_text(document)
    number = F.coalesce(F.get_json_object(document, "$._id.$numberInt"), F.get_json_object(document, "$._id.$numberLong"))
    return F.coalesce(number, raw)


NUMBERS = ("$numberInt", "$numberLong", "$numberDouble", "$numberDecimal")


def typed_id(document):
    """struct<type, number, text> of a document's _id: object ids, numbers and strings compare within their own type."""
    raw = F.try_parse_json(document)
    shape = F.schema_of_variant(F.try_variant_get(raw, "$._id", "variant"))
    number = F.coalesce(*[F.get_json_object(document, f"$._id.{n}") for n in NUMBERS], F.when(shape.rlike("^(BIGINT|DOUBLE|DECIMAL)"), id_text(document))).try_cast("decimal(38,10)")
    oid = F.get_json_object(document, "$._id['$oid']")
    kind = F.when(oid.isNotNull(), "objectId").when(number.isNotNull(), "number").when(shape == "STRING", "string").otherwise("other")
    return F.struct(kind.alias("type"), number.alias("number"), F.coalesce(F.lower(oid), id_text(document)).alias("text"))


def typed_bound(text: str) -> tuple[str, str, object]:
    """Type, field to compare and value of a range's end given as text: 24 hexadecimal digits, a number, or a string."""
    if re.fullmatch("[0-9a-fA-F]{24}", text):
        return "objectId", "text", text.lower()
    if re.fullmatch(r"[+-]?\d+(\.\d+)?", text):
        return "number", "number", decimal.Decimal(text)
    return "string", "text", text


def scan(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """(id, document) of JSON lines, of ids from start to end, both included; a bound meets ids of its own type only."""
    lines = spark.read.text(path).select(key_text(F.col("value")).alias("id"), F.col("value").alias("document"))
    for bound, met in ((start, lambda a, b: a >= b), (end, lambda a, b: a <= b)):
        if bound is not None:
            kind, field, value = typed_bound(bound)
            of = typed_id(F.col("document"))
            lines = lines.where((of["type"] == kind) & met(of[field], F.lit(value)))
    return lines


def snapshot(df: DataFrame, collection: str) -> DataFrame:
    """Documents as events with op r."""
    return df.select(F.lit(collection).alias("coll"), F.struct(F.col("id")).alias("key"), F.lit(None).cast("string").alias("before"), F.col("document").alias("after"), F.lit("r").alias("op"))


@source_of("mongodb")
def read(spark: SparkSession, source: SourceConfig, table: TableConfig) -> DataFrame:
    bound = lambda v: v if isinstance(v, str) or v is None else v[0]
    return scan(spark, f"{source.options['path']}/{table.name}", bound(table.start), bound(table.end))
