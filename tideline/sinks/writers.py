"""Writing events: messages to a broker or files, rows to tables with dedupe or merge."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import changes
from tideline.plans.config import SinkConfig
from tideline.session import fresh

REQUEST_BYTES = 1_048_576
UPDATED, DB_UPDATED, DELETED = "__updated_at", "__db_updated_at", "__deleted"
CHANGE_SETS = 16  # that are laid over a whole version before the next whole one is written, at most


def kafka_options(given: dict) -> dict[str, str]:
    """Options of Spark's Kafka sink. Messages go to partitions by key, so that those of a key keep their order."""
    out = {
        "kafka.bootstrap.servers": given["bootstrapServers"], "kafka.compression.type": "gzip", "kafka.max.request.size": str(given.get("maxRequestSize", REQUEST_BYTES)),
        "kafka.retries": "10", "kafka.retry.backoff.ms": "100", "kafka.retry.backoff.max.ms": "5000", "kafka.request.timeout.ms": "5000",
    }
    mechanism = given.get("authMechanism", "none")
    if mechanism == "scram-sha-512":
        out |= {
            "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "SCRAM-SHA-512",
            "kafka.sasl.jaas.config": f'org.apache.kafka.common.security.scram.ScramLoginModule required username="{given["username"]}" password="{given["password"]}";',
        }
    elif mechanism == "aws-msk-iam":
        out |= {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "AWS_MSK_IAM"}
    return out


def publish(messages: DataFrame, options: dict) -> None:
    """(topic, key, value) to a broker, or to JSON files where `path` is given."""
    if "path" in options:
        messages.write.mode("append").json(options["path"])
    else:
        messages.write.format("kafka").options(**kafka_options(options)).save()


class TableSink:
    """A table as versions of Parquet below a folder; nothing is overwritten in place.

    A version is the whole table or a set of changes: the last image of each changed key, and whether it was removed. Who
    reads takes the newest whole version and lays the later change sets over it in one aggregation by key (null keys
    count as equal), so that a batch writes its own rows and not the table. When the change sets are many or have half
    the bytes of the whole version, the next whole one is written.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], soft_delete: bool = False, updated: bool = False):
        self.spark, self.path, self.keys, self.soft_delete, self.updated = spark, path, keys, soft_delete, updated

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        path = self._path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def versions(self) -> list[str]:
        """Complete versions, oldest first."""
        fs, path = self._files()
        if not fs.exists(path):
            return []
        jvm = self.spark.sparkContext._jvm
        done = [s.getPath() for s in fs.listStatus(path) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted(p.toString() for p in done)

    def _current(self) -> list[str]:
        """The newest whole version and the change sets after it."""
        found = self.versions()
        whole = [i for i, v in enumerate(found) if "-changes-" not in v.rsplit("/", 1)[-1]]
        return found[whole[-1] :] if whole else []

    def read(self) -> DataFrame | None:
        current = self._current()
        if not current:
            return None
        whole = self.spark.read.parquet(current[0])
        if len(current) == 1:
            return whole
        if self.soft_delete and DELETED not in whole.columns:
            whole = whole.withColumn(DELETED, F.lit(False))
        removed, load, left = (fresh(whole.columns, x) for x in ("__removed", "__load", "__left"))
        every = changes.union_all([whole.withColumns({removed: F.lit(False), load: F.lit(0)}), *[self.spark.read.parquet(v).withColumn(load, F.lit(i)) for i, v in enumerate(current[1:], 1)]])
        there = F.when(~F.col(removed), F.col(load))
        last = every.groupBy(*self.keys).agg(F.max_by(F.struct(*whole.columns), there).alias("image"), F.max(there).alias(load), F.max(F.when(F.col(removed), F.col(load))).alias(left))
        gone = F.coalesce(F.col(left) > F.col(load), F.lit(False))
        rows = last.where(F.col(load).isNotNull() & (F.lit(self.soft_delete) | ~gone))
        return rows.select(*[(F.col(f"image.{c}") | gone if self.soft_delete and c == DELETED else F.col(f"image.{c}")).alias(c) for c in whole.columns])

    def _next(self, kind: str) -> str:
        found = self.versions()
        number = int(found[-1].rsplit("/", 1)[-1][1:9]) + 1 if found else 0
        return f"{self.path}/v{number:08d}-{kind}{uuid.uuid4().hex[:8]}"

    def put(self, df: DataFrame) -> None:
        """A whole version."""
        df.write.parquet(self._next(""))

    def _put_changes(self, images: DataFrame, gone: Column) -> None:
        """A change set: one row per key, in the table's columns; then a whole version if it is due."""
        columns = self.read().columns
        removed = fresh(columns, "__removed")
        images.withColumn(removed, F.coalesce(gone, F.lit(False))).select(*columns, removed).write.parquet(self._next("changes-"))
        fs, _ = self._files()
        whole, *sets = [fs.getContentSummary(self._path(v)).getLength() for v in self._current()]
        if len(sets) >= CHANGE_SETS or 2 * sum(sets) >= whole:
            self.put(self.read())

    def vacuum(self, keep: int = 2) -> int:
        """Delete what lies before the last `keep` whole versions; the number of versions deleted. Who still reads one fails."""
        found = self.versions()
        whole = [i for i, v in enumerate(found) if "-changes-" not in v.rsplit("/", 1)[-1]]
        old = found[: whole[-keep]] if 0 < keep <= len(whole) else []
        for v in old:
            self._files()[0].delete(self._path(v), True)
        return len(old)

    def prepare(self, action: str) -> None:
        """Before a backfill: nothing, truncate (no rows, schema kept) or drop."""
        fs, path = self._files()
        if action == "drop":
            fs.delete(path, True)
        elif action == "truncate" and (old := self.read()) is not None:
            self.put(old.where("false"))
        elif action not in ("none", "truncate"):
            raise ValueError(f"unknown action: {action}")

    def create_empty(self, df: DataFrame) -> None:
        self.put(self._marked(df.where("false")))

    def _marked(self, df: DataFrame) -> DataFrame:
        out = df.withColumn(UPDATED, F.current_timestamp()) if self.updated and UPDATED not in df.columns else df
        return out.withColumn(DELETED, F.lit(False)) if self.soft_delete and DELETED not in out.columns else out

    def append(self, df: DataFrame, order: list[str]) -> None:
        """Add rows, then keep the last of each key: by the order, and in the end, or without one, those loaded later."""
        old, new = self.read(), self._marked(df)
        load = fresh(new.columns, "_load")
        if old is None or order:
            whole = new.withColumn(load, F.lit(1))
            if old is not None:
                whole = old.withColumn(load, F.lit(0)).unionByName(whole)
            self.put(changes.latest(whole, self.keys, [*order, load]).drop(load))
        else:
            self._put_changes(changes.latest(new, self.keys, []), F.lit(False))

    def merge(self, df: DataFrame, op: str, order: list[str]) -> None:
        """Apply changes: of each key the last by the order, whatever the table has; d removes or flags it, others upsert."""
        if self.read() is None:
            self.create_empty(df.drop(op))
        self._put_changes(self._marked(changes.latest(df, self.keys, order)), F.col(op) == "d")


def write(batches: list[DataFrame], put: Callable[[DataFrame], None], commit: Callable[[], None] = lambda: None, complete: Callable[[], None] = lambda: None) -> int:
    """Write batch after batch, committing after each that has rows; complete runs once if any had."""
    total = 0
    for b in batches:
        n = b.count()
        if n:
            put(b)
            commit()
            total += n
    if total:
        complete()
    return total


def sink(config: SinkConfig, spark: SparkSession, keys: list[str]):
    """The sink of a configuration: a function of messages, or a table."""
    if config.kind == "kafka":
        return lambda messages: publish(messages, config.options)
    return TableSink(spark, config.options["path"], keys, bool(config.options.get("softDelete")), bool(config.options.get("includeUpdatedAt")))
