"""Exact deduplication through a minimal perfect hash over historical digests.

The distinct SHA-256 digests of the history are dealt to shards of a bounded size. Each shard gets a minimal perfect
hash by hash-and-displace: a digest picks a bucket, the bucket's pilot picks the slot, and n digests fill n slots.
Slots hold the full digest, the locator of its winner (its smallest doc_id) and its number of copies. A digest that
arrives later is looked up by pilot and slot and counts as a repeat only if all 32 bytes agree; those that are no
members are grouped among themselves.

Defined results: a null text counts as empty; rows with a null doc_id lose to any other row of their group; an empty
table gives no rows; other columns are ignored. Rows that repeat a doc_id and a text are all marked kept by
`exact_duplicates`, and `keep_first` returns one of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import first_by
from tideline.session import fresh, settled

SHARD_ROWS = 4096  # digests of a shard, about; its index row takes some 200 kB
KEYS_PER_BUCKET = 4
TRIES = 128  # pilots tried by one numpy call
DIGEST = 32


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text):
    """SHA-256 of the text with white space runs as one space, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def _mixed(words: np.ndarray, pilot) -> np.ndarray:
    """A 64-bit finaliser over the digest's own bits and a pilot."""
    with np.errstate(over="ignore"):
        x = words ^ (np.asarray(pilot, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def build_mph(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots by bucket and the slot of each digest, for distinct digests as an (n, 32) byte array.

    Buckets of two or more take the first pilot that sends their keys to free, different slots, largest bucket first;
    single keys then take the slots that are left, and their pilot names the slot as -1 - slot.
    """
    n = len(digests)
    words = np.ascontiguousarray(digests).view(np.uint64)
    buckets = max(1, n // KEYS_PER_BUCKET)
    home = (words[:, 0] % np.uint64(buckets)).astype(np.int64)
    pilots, slots, free = np.zeros(buckets, np.int64), np.full(n, -1, np.int64), np.ones(n, bool)
    order = np.argsort(home, kind="stable")
    starts = np.searchsorted(home[order], np.arange(buckets + 1))
    sizes = np.diff(starts)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] < 2:
            break
        keys = order[starts[b] : starts[b + 1]]
        for first in range(1, 1 << 31, TRIES):
            tried = np.arange(first, first + TRIES, dtype=np.uint64)
            at = (_mixed(words[keys, 1][None, :], tried[:, None]) % np.uint64(n)).astype(np.int64)
            fits = free[at].all(axis=1)
            fits[fits] = (np.diff(np.sort(at[fits], axis=1), axis=1) > 0).all(axis=1)
            if fits.any():
                break
        best = int(fits.argmax())
        pilots[b], at = int(tried[best]), at[best]
        slots[keys] = at
        free[at] = False
    left = np.flatnonzero(free)
    single = [order[starts[b]] for b in np.flatnonzero(sizes == 1)]
    for key, slot in zip(single, left, strict=True):
        slots[key], pilots[home[key]] = slot, -1 - slot
    return pilots, slots


def find_slots(digests: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    """The only slot in which each digest can be."""
    words = np.ascontiguousarray(digests).view(np.uint64)
    pilot = pilots[(words[:, 0] % np.uint64(len(pilots))).astype(np.int64)]
    hashed = (_mixed(words[:, 1], np.maximum(pilot, 0).astype(np.uint64)) % np.uint64(n)).astype(np.int64)
    return np.where(pilot < 0, -1 - pilot, hashed)


def _bytes(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), np.uint8).reshape(-1, DIGEST)


def _index_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    digests = _bytes(rows["digest"])
    pilots, slots = build_mph(digests)
    back = np.argsort(slots)
    winners = rows["winner"].to_numpy()[back]
    return pd.DataFrame(
        {
            "shard": [key[0]],
            "pilots": [pilots.tobytes()],
            "slots": [digests[back].tobytes()],
            "winners": [winners.astype(np.int64).tobytes()],
            "copies": [rows["copies"].to_numpy()[back].astype(np.int64).tobytes()],
        }
    )


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard with pilots and slots; history: distinct digests with winner and copies."""
    dealt = history.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
    schema = "shard long, pilots binary, slots binary, winners binary, copies binary"
    return dealt.groupBy("shard").applyInPandas(_index_shard, schema)


def _look_up(key: tuple, index: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """All groups of a shard: its slots with the repeats that came in, then the digests that aren't members."""
    new = pd.DataFrame({"digest": rows["digest"].map(bytes), "keep_id": rows["first_id"], "group_size": rows["copies"]})
    if not len(index):
        return new
    slots = np.frombuffer(index["slots"][0], np.uint8).reshape(-1, DIGEST)
    winners = np.frombuffer(index["winners"][0], np.int64)
    copies = np.frombuffer(index["copies"][0], np.int64).copy()
    if len(rows):
        asked = _bytes(rows["digest"])
        at = find_slots(asked, np.frombuffer(index["pilots"][0], np.int64), len(slots))
        member = (slots[at] == asked).all(axis=1)
        np.add.at(copies, at[member], rows["copies"].to_numpy()[member])
        new = new[~member]
    old = pd.DataFrame({"digest": [x.tobytes() for x in slots], "keep_id": winners, "group_size": copies})
    old["keep_id"] = old["keep_id"].astype("Int64")
    return pd.concat([old, new.astype({"keep_id": "Int64"})])


def look_up(index: DataFrame, arrived: DataFrame, shards: int) -> DataFrame:
    """(digest, keep_id, group_size) of every digest in the index or among those that arrived (distinct, with first_id and copies)."""
    dealt = arrived.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
    return index.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(_look_up, "digest binary, keep_id long, group_size long")


def groups(digests: DataFrame, split: int | None) -> DataFrame:
    """(digest, keep_id, group_size) per distinct digest of (doc_id, digest); rows below split are the history."""
    old = F.coalesce(F.col("doc_id") < F.lit(split), F.lit(False))
    counted = [F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")]
    history = settled(digests.where(old).groupBy("digest").agg(*counted).withColumnRenamed("first_id", "winner"))
    arrived = settled(digests.where(~old).groupBy("digest").agg(*counted))
    shards = 1 + max(history.count(), arrived.count()) // SHARD_ROWS
    return look_up(build_index(history, shards), arrived, shards)


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, digest and, by group, keep_id and group_size."""
    digests = settled(docs.select("doc_id", digest(F.col("text")).alias("digest")))
    low, high = digests.agg(F.min("doc_id"), F.max("doc_id")).first()
    split = None if low is None else low + (high - low) // 2 + 1
    return digests.join(settled(groups(digests, split)), "digest")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, keep_id (smallest doc_id of its equal texts), group_size, kept, text_sha256.

    The older half of the doc_id range is the history over which the index is built; the rest is looked up in it.
    """
    return _marked(docs).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, all columns; of rows equal in doc_id and text, the first by a hash of all
    columns, as common.first_by."""
    key, hashed = (fresh(docs.columns, x) for x in ("_id_key", "_digest"))
    as_key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    stay = _marked(docs).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(as_key(F.col("doc_id")).alias(key), F.col("digest").alias(hashed))
    known = docs.withColumns({key: as_key(F.col("doc_id")), hashed: digest(F.col("text"))}).join(stay, [key, hashed], "left_semi")
    return first_by(known, [key, hashed], docs.columns)
