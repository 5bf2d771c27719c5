"""Applying changes to tables: dedupe, merge, soft delete; and checks of schema age and replay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import fresh, settled


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last in a total order. Partial aggregation keeps one row per key and task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    top = F.max(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], F.struct(*rest).alias("_rest")))
    return df.groupBy(*keys).agg(top.alias("_top")).select(*[F.col(c) if c in keys else F.col(f"_top._rest.{c}").alias(c) for c in df.columns])


def merge(target: DataFrame, changes: DataFrame, keys: list[str], op: str, order: list[str], delete: bool = True) -> DataFrame:
    """target with the last change of each key applied: c, u and r upsert, d deletes (or is kept back with delete=False)."""
    last = latest(changes, keys, order)
    images = last.where(F.col(op) != "d") if delete else last
    return target.join(last, keys, "left_anti").unionByName(images.select(*target.columns))


def soft_delete(target: DataFrame, changes: DataFrame, keys: list[str], op: str, order: list[str], flag: str) -> DataFrame:
    """Like merge, but a deleted row stays with its last image and the flag set."""
    last = latest(changes, keys, order)
    gone = target.join(last.where(F.col(op) == "d").select(*keys, F.lit(True).alias(flag)), keys, "left")
    kept = gone.join(last.where(F.col(op) != "d").select(*keys), keys, "left_anti").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return kept.unionByName(last.where(F.col(op) != "d").select(*target.columns, F.lit(False).alias(flag)))


def highest(interval: DataFrame, sid: str, stop: str) -> DataFrame:
    """Largest transaction of each server's intervals."""
    return interval.groupBy(sid).agg(F.max(stop).alias("highest"))


def transaction(gtid: Column) -> list[Column]:
    """Server and transaction number of "sid:tx"; an error for another form."""
    good = gtid.rlike(r"^[^:]+:\d+$")
    part = lambda i: F.when(good, F.split(gtid, ":")[i]).otherwise(F.raise_error(F.concat(F.lit("invalid transaction id: "), gtid)))
    return [part(0), part(1).cast("bigint")]


def not_replayed(events: DataFrame, seen: DataFrame, sid: str, tx: str, stop: str) -> DataFrame:
    """Events of unknown servers, and those whose transaction is at or above the highest seen; whole transactions go."""
    marks = highest(seen, sid, stop)
    return events.join(marks, sid, "left").where(F.col("highest").isNull() | (F.col(tx) >= F.col("highest"))).drop("highest")


def not_stale(events: DataFrame, schemas: DataFrame, keys: list[str], at: str, since: str) -> DataFrame:
    """Events that aren't older than the newest schema version of their table."""
    newest = schemas.groupBy(*keys).agg(F.max(since).alias("_since"))
    return events.join(newest, keys, "inner").where(F.col("_since") <= F.col(at)).drop("_since")


def batches_by_bytes(df: DataFrame, size: Column, order: list[str], most: int, group: str) -> DataFrame:
    """Rows with the number of the batch they fall in by cumulated bytes, within each group.

    Groups may be few and large, so rows are dealt out by ranges of group and order, cumulated within each range, and
    the sums of a group's earlier ranges are added. Rows of one group that tie in the order stay in one range.
    """
    part, carry, bytes_ = (fresh(df.columns, x) for x in ("_part", "_carry", "_bytes"))
    dealt = settled(df.withColumn(bytes_, size.cast("long")).repartitionByRange(group, *order).withColumn(part, F.spark_partition_id()))
    # a row for each range and group in it: as many as there are partitions and groups
    sums = dealt.groupBy(group, part).agg(F.sum(bytes_).alias(carry))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col(group).alias(f"{group}_of"), F.col(part).alias(f"{part}_of"), F.coalesce(F.sum(carry).over(earlier), F.lit(0)).alias(carry))
    known = dealt.join(before, F.col(group).eqNullSafe(F.col(f"{group}_of")) & (F.col(part) == F.col(f"{part}_of")))
    upto = Window.partitionBy(part, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return known.withColumn("batch", F.floor((F.sum(bytes_).over(upto) + F.col(carry) - 1) / most)).select(*[F.col(f"`{c}`") for c in df.columns], "batch")


def ready_shards(shards: DataFrame, shard: str, parent: str, seen: str, processed: str) -> DataFrame:
    """Shards that can be read: not processed, and whose parent is unknown, unseen or processed."""
    up = shards.select(F.col(shard).alias("_id"), F.col(seen).alias("_seen"), F.col(processed).alias("_processed"))
    known = shards.join(up, F.col(parent) == F.col("_id"), "left")
    blocked = F.coalesce(F.col("_seen") & ~F.col("_processed"), F.lit(False))
    return known.where(~F.col(processed) & ~blocked).select(*shards.columns)


def live(df: DataFrame, at: str, ttl_seconds: int, now: Column) -> DataFrame:
    """Rows whose lifetime hasn't ended."""
    return df.where(F.col(at) + F.expr(f"INTERVAL {ttl_seconds} SECONDS") > now)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
