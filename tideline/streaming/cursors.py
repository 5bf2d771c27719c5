"""Change streams of a document store: one cursor, resumed by its token.

A store hands out one ordered cursor for a database, so a batch of at most `rows` changes is read where the query is
planned; what follows runs in the cluster. The offset is the token after the batch's last change, as base64. The
checkpoint keeps it once the sink has written, and a batch that is tried again is read again between its two tokens.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from tideline.operators.envelope import DOCUMENT_OPS

SCHEMA = "operationType string, id string, coll string, ts_ms long, full string, full_before string"


class Cursor(Protocol):
    """Changes after a place: the next one with the token to resume after it, or None where there is none yet."""

    def try_next(self) -> tuple[bytes, dict] | None: ...


#: Opens a cursor from (kinds of operations, whether images from before are wanted, token to resume after).
Open = Callable[[list[str], bool, bytes | None], Cursor]


def driver_cursor(url: str, database: str) -> Open:
    """Cursors of a store's own driver, where it is installed: whole documents are looked up for updates, images from
    before come where the store keeps them."""

    def opened(kinds: list[str], before: bool, token: bytes | None) -> Cursor:
        import bson
        import pymongo
        from bson import json_util

        stream = pymongo.MongoClient(url)[database].watch(
            [{"$match": {"operationType": {"$in": kinds}}}], full_document="updateLookup",
            full_document_before_change="whenAvailable" if before else None, resume_after=bson.decode(token) if token else None,
        )

        class Driven:
            def try_next(self) -> tuple[bytes, dict] | None:
                found = stream.try_next()
                if found is None:
                    return None
                return bson.encode(found["_id"]), json.loads(json_util.dumps(found, json_options=json_util.CANONICAL_JSON_OPTIONS))

        return Driven()

    return opened


def change(event: dict) -> tuple:
    """A change as a row; documents and ids as extended JSON texts. Its shape is checked by `envelope.document_change`."""
    text = lambda v: None if v is None else json.dumps(v, separators=(",", ":"), ensure_ascii=False)
    seconds = ((event.get("clusterTime") or {}).get("$timestamp") or {}).get("t")
    return (
        event.get("operationType"), text((event.get("documentKey") or {}).get("_id")), (event.get("ns") or {}).get("coll"),
        None if seconds is None else int(seconds) * 1000, text(event.get("fullDocument")), text(event.get("fullDocumentBeforeChange")),
    )


class CursorReader(SimpleDataSourceStreamReader):
    def __init__(self, opened: Open, collections: list[str], rows: int, before: bool):
        self.opened, self.collections, self.rows, self.before = opened, set(collections), rows, before
        self.cursor: Cursor | None = None
        self.at: dict | None = None

    def _after(self, offset: dict) -> Cursor:
        return self.opened(sorted(DOCUMENT_OPS), self.before, base64.b64decode(offset["token"]) or None)

    def _watched(self, row: tuple) -> bool:
        return row[2] is None or row[2] in self.collections

    def initialOffset(self) -> dict:
        return {"token": ""}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        """Up to `rows` changes of watched collections; the token moves over others as well. The cursor stays open where
        the next batch begins."""
        if self.cursor is None or self.at != start:
            self.cursor = self._after(start)
        found, self.at = [], start
        while len(found) < self.rows and (got := self.cursor.try_next()) is not None:
            self.at = {"token": base64.b64encode(got[0]).decode()}
            found += [row for row in (change(got[1]),) if self._watched(row)]
        return iter(found), self.at

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        cursor, last, token = self._after(start), base64.b64decode(end["token"]), base64.b64decode(start["token"])
        while token != last and (got := cursor.try_next()) is not None:
            token, row = got[0], change(got[1])
            if self._watched(row):
                yield row

    def commit(self, end: dict) -> None:
        pass


def change_stream(spark: SparkSession, opened: Open, collections: list[str], rows: int = 5_000, before: bool = True) -> DataFrame:
    """Changes of the watched collections as a stream, in the columns that `envelope.document_change` takes, with ts_ms."""

    class ChangeStream(DataSource):
        @classmethod
        def name(cls) -> str:
            return "tideline_cursor"

        def schema(self) -> str:
            return SCHEMA

        def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
            return CursorReader(opened, collections, rows, before)

    spark.dataSource.register(ChangeStream)
    return spark.readStream.format("tideline_cursor").load()
