"""Connected components by alternating large and small stars, every round written to the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import settled


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (a, b) that has a link to another; root is the smallest node reachable.

    A large star ties each node's larger neighbours to its smallest one, a small star does so for its smaller ones; in
    the end every component is one star. Stars are joined after their minima are written, so that Spark can split a
    hub's rows over tasks. Nothing but a count and a checksum reaches the driver.
    """
    edges = settled(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi != lo").distinct())
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = settled(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = settled(both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        low = settled(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = large.join(low, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = settled(small.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
