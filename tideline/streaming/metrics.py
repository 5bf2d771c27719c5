"""Counts and lags, gathered by Spark while queries run."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("tideline")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df, and its number of rows once an action has run: no second pass over the data."""
    seen = Observation(f"{name}-rows")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


class Progress(StreamingQueryListener):
    """Rows, batch time and lag of each micro-batch, as numbers for a metrics client."""

    def __init__(self, put=lambda name, value, tags: None):
        self.put, self.rows, self.batches = put, 0, 0

    def onQueryStarted(self, event) -> None:
        log.info("query started: %s", event.id)

    def onQueryProgress(self, event) -> None:
        told = json.loads(event.progress.json)
        tags = {"query": told.get("name") or told["id"]}
        self.rows += told.get("numInputRows", 0)
        self.batches += 1
        self.put("stream.rows", told.get("numInputRows", 0), tags)
        self.put("stream.batch_ms", told.get("durationMs", {}).get("triggerExecution", 0), tags)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("query ended: %s", event.id)


def lag_ms(df: DataFrame, ts_ms: str, now_ms) -> DataFrame:
    """The greatest age of an event, in milliseconds."""
    return df.agg(F.max(now_ms - F.col(ts_ms)).alias("lag_ms"))
