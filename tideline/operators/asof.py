"""As-of lookup: for each row the latest item at or before its time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """left with the values of right's latest row of the same keys at or before left_time; nulls if there is none.

    Both sides are sorted together once by key and time, so the cost is one shuffle, whatever the number of matches. Rows
    of right with the same keys and time: the greatest values win. Columns of left keep their names.
    """
    columns = left.columns
    items = F.struct(*[F.col(v) for v in values])
    stated = right.select(*keys, F.col(right_time).alias("_at"), F.lit(0).alias("_side"), items.alias("_item"), F.lit(None).cast(left.select(F.struct(*columns).alias("r")).schema["r"].dataType).alias("_row"))
    asked = left.select(*keys, F.col(left_time).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(stated.schema["_item"].dataType).alias("_item"), F.struct(*columns).alias("_row"))
    until = Window.partitionBy(*keys).orderBy("_at", "_side", "_item").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = stated.unionByName(asked).withColumn("_found", F.last("_item", ignorenulls=True).over(until)).where("_side = 1")
    return known.select("_row.*", *[F.col(f"_found.{v}").alias(v) for v in values])


def bucketed_as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str], width: int) -> DataFrame:
    """As-of for hot keys, or for none: time is cut into buckets of `width` seconds, each bucket carries in the last item before it.

    No task sees more of a key than a bucket. What is carried is one row per key and bucket that has rows.
    """
    bucket = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (width * 1_000_000))
    marked = right.select(*keys, F.col(right_time).alias("_rt"), *values).withColumn("_b", bucket("_rt"))
    last = marked.groupBy(*keys, "_b").agg(F.max(F.struct("_rt", *values)).alias("_last"))
    asked = left.select("*", bucket(left_time).alias("_b"))
    order = (Window.partitionBy(*keys) if keys else Window).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    frames = asked.select(*keys, "_b").distinct().join(last, [*keys, "_b"], "full").withColumn("_before", F.last("_last", ignorenulls=True).over(order))
    carried = frames.where(F.col("_before").isNotNull()).select(*keys, "_b", "_before._rt", *[F.col(f"_before.{v}").alias(v) for v in values])
    return as_of(asked, marked.unionByName(carried), [*keys, "_b"], left_time, "_rt", values).drop("_b")
