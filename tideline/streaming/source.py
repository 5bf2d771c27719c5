"""Logs of decoded events as Structured Streaming sources.

A log is a folder of JSON lines, each file a shard or a log file, as a decoder for a binary log or a change stream
leaves them, on any file system that Arrow knows by its address. `log` plans micro-batches by (file, byte, line) offsets,
at most `rows` events a batch, one partition per file; planning and reading start at the last offset, so a trigger costs
what is new. The checkpoint commits an offset only after the sink has written. A last line without its end is left for
later, unless it is whole JSON already; lines without content are no events.
"""

from __future__ import annotations

import io
import json
import posixpath
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "shard string, pos long, kind string, db string, tbl string, ts long, gtid string, body string"


def whole(line: bytes) -> bool:
    if line.endswith(b"\n"):
        return True
    try:
        json.loads(line)
    except ValueError:
        return False
    return True


def lines(path: str, start: int) -> Iterator[tuple[int, bytes]]:
    """(byte after it, line) of a file's whole lines from a byte on."""
    store, inner = fs.FileSystem.from_uri(path)
    with io.BufferedReader(store.open_input_file(inner), 1 << 20) as f:
        f.seek(start)
        at = start
        for line in f:
            if not whole(line):
                return
            at += len(line)
            yield at, line


class Lines(InputPartition):
    def __init__(self, path: str, start: list[int], end: list[int]):
        self.path, self.start, self.end = path, start, end


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str, rows: int):
        self.path, self.rows, self.planned = path, rows, {}

    def _sizes(self) -> dict[str, int]:
        store, inner = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(inner))
        return {f.base_name: f.size for f in sorted(found, key=lambda f: f.base_name) if f.is_file and f.base_name.endswith(".jsonl")}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """All that the last batch had, and up to `rows` events more, files in order."""
        self.planned, left = dict(self.planned), self.rows
        for name, size in self._sizes().items():
            byte, line = self.planned.get(name, [0, 0])
            if left and size > byte:
                for at, text in lines(posixpath.join(self.path, name), byte):
                    byte = at
                    if text.strip():
                        line, left = line + 1, left - 1
                    if not left:
                        break
                self.planned[name] = [byte, line]
        return self.planned

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.planned = dict(end)
        return [Lines(posixpath.join(self.path, n), start.get(n, [0, 0]), e) for n, e in end.items() if e[1] > start.get(n, [0, 0])[1]]

    def read(self, part: Lines):
        (byte, line), end = part.start, part.end[0]
        for at, text in lines(part.path, byte):
            if at > end:
                return
            if text.strip():
                e = json.loads(text)
                yield (posixpath.basename(part.path), line, e.get("kind"), e.get("db"), e.get("table"), e.get("ts"), e.get("gtid"), json.dumps(e.get("body")))
                line += 1

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class ChangeLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tideline_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogReader(self.options["path"], int(self.options.get("rows", "5000")))


def log(spark: SparkSession, path: str, rows: int = 5_000) -> DataFrame:
    spark.dataSource.register(ChangeLog)
    return spark.readStream.format("tideline_log").option("path", path).option("rows", str(rows)).load()


def files(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of decoded events as a stream, for logs that a store can only list."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
