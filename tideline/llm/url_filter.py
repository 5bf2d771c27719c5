"""URL filters by a temporal list join.

A list is a log of dated entries: a domain is added to or removed from a named list on a day. Entries become validity
intervals [day, day of the list's next entry for that domain), and each capture is evaluated against the entries that
were active when it was fetched: an entry matches its domain and every subdomain.

Captures are first brought down to distinct pairs of host and day, so that a host with a third of all captures costs no
more than its days; each pair is spread to the suffixes of its host and meets the intervals of that suffix. The lists
are broadcast only after their rows are counted and found few; beyond that Spark shuffles both sides.

Defined results: a capture with a null or unreadable URL or a null day is not blocked and matches no entry; entries with
a null domain, list, action or day are ignored; of entries of one list, domain and day a removal wins; repeated
entries count once; rows that repeat a page_id give one result row each; empty tables give no rows or no matches; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import settled

BROADCAST_ROWS = 200_000  # intervals that are broadcast at most, some 20 MB
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host(url: Column) -> Column:
    """Lower-case host without user, port and final dots; null where there is none."""
    return F.nullif(F.regexp_replace(F.regexp_extract(F.lower(F.trim(url)), HOST, 1), r"[.]+$", ""), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, valid_from, valid_to) from (list, domain, action, day); valid_to is null while an entry is active."""
    log = entries.select("list", F.regexp_replace(F.lower("domain"), r"^[.]+|[.]+$", "").alias("domain"), "action", F.col("day").cast("date").alias("day"))
    # a later name wins within a day: 'remove' after 'add'
    log = log.dropna().groupBy("list", "domain", "day").agg(F.max("action").alias("action"))
    following = Window.partitionBy("list", "domain").orderBy("day")
    return log.withColumn("valid_to", F.lead("day").over(following)).where(F.col("action") == "add").select("list", "domain", F.col("day").alias("valid_from"), "valid_to")


def _suffixes(name: Column) -> Column:
    parts = F.split(name, r"[.]", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per capture (page_id, url, day): page_id, host, day, blocked, n_entries, entry and list.

    entry and list name the active match with the longest domain, ties by domain, then by list name.
    """
    active = settled(intervals(entries))
    seen = captures.select("page_id", host(F.col("url").cast("string")).alias("host"), F.col("day").cast("date").alias("day"))
    pairs = seen.select("host", "day").dropna().distinct().withColumn("domain", F.explode(_suffixes(F.col("host"))))
    right = F.broadcast(active) if active.count() <= BROADCAST_ROWS else active
    met = pairs.join(right, "domain").where((F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    order = F.struct(-F.length("domain"), F.col("domain"), F.col("list"))
    found = met.groupBy("host", "day").agg(F.count(F.lit(1)).alias("n_entries"), F.min(order).alias("best"))
    found = settled(found.select("host", "day", "n_entries", F.col("best.domain").alias("entry"), F.col("best.list").alias("list")))
    return seen.join(found, ["host", "day"], "left").select("page_id", "host", "day", F.col("n_entries").isNotNull().alias("blocked"), F.coalesce("n_entries", F.lit(0).cast("long")).alias("n_entries"), "entry", "list")
