"""Session helpers shared by every part of the library."""

from __future__ import annotations

import json
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, read by Spark so any file system it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; where none is set, make a folder on a local master and fail on any other,
    as executors would not share it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(given or tempfile.mkdtemp(prefix="tideline-"))


def settled(df: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder, its lineage cut; a lost executor loses nothing of it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(columns: list[str], name: str) -> str:
    """A column name that clashes with none of the given ones, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows as a table, by SQL functions alone."""
    given = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(given).alias("r")).select("r.*")
