"""SimHash near-duplicates by a tiled exact comparison of all distinct fingerprints.

A fingerprint has 64 bits by majority over the XXH64 of a text's 3-word shingles. Distinct fingerprints are tiled by the
population counts of their four 16-bit quarters (at most 17^4 tiles). Two fingerprints at distance d have quarter counts
that differ by d in sum at most, so a pair of tiles whose counts differ beyond the radius is skipped whole; the others
are compared fingerprint by fingerprint with numpy's exclusive-or and bit counts. A tile is cut into sub-tiles of a
bounded size, and what one task compares is bounded too, so a crowded tile is spread over tasks. A task reports a
spanning forest of the links it found, not all pairs; components then follow in components.py.

Defined results: a null or wordless text has fingerprint zero and links like any other; fewer than three words make one
shingle; equal fingerprints are one class; rows that repeat a doc_id give one result row each; a component whose
doc_ids are all null has a null component_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import first_by
from tideline.llm.components import connected_components
from tideline.session import fresh, settled

SHINGLE, SEED, RADIUS = 3, 42, 3
SUB_TILE = 2048  # fingerprints of a sub-tile at most, about
SUB_TILES_AT_ONCE = 32  # sub-tiles of each neighbour that one task compares with
AT_ONCE = 1 << 21  # pairs compared by one numpy call
QUARTERS = 17  # population counts of 16 bits


def simhash(text: str | None) -> int:
    """The fingerprint, unsigned."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and splits at x20, x09-x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= SHINGLE:
        spans = [(0, len(joined))]
    else:
        spans = zip(np.concatenate([[0], ends[: -SHINGLE] + 1]).tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        values = np.fromiter(map(simhash, batch["text"]), np.uint64, len(batch)).view(np.int64)
        yield batch.drop(columns="text").assign(doc_id=batch["doc_id"].astype("Int64"), fp=values)


def _digest():
    return F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))


def fingerprints(docs: DataFrame, digests: bool = False) -> DataFrame:
    """(doc_id, fp) per row, with the text's SHA-256 as digest if asked for; fp as a signed 64-bit number."""
    more, kind = ([_digest().alias("digest")], ", digest binary") if digests else ([], "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more).mapInPandas(_fingerprints, "doc_id long, fp long" + kind)


def _ball() -> list[tuple[int, ...]]:
    """Differences of quarter counts within the radius, of each and its opposite one."""
    steps = range(-RADIUS, RADIUS + 1)
    near = [d for d in itertools.product(steps, repeat=4) if sum(map(abs, d)) <= RADIUS]
    return [d for d in near if d >= (0, 0, 0, 0)]


def _quarters(fp):
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int") for i in range(4)]


def _code(parts):
    code = parts[0]
    for p in parts[1:]:
        code = code * QUARTERS + p
    return code


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i] for all i; label names each node's set by its least node, before and after."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        np.minimum.at(label, np.maximum(x, y)[differ], np.minimum(x, y)[differ])
        while (label[label] != label).any():
            label[:] = label[label]


def _links(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Spanning forest of the links between a sub-tile and what it meets, and within itself."""
    own = np.frombuffer(rows["fps"][rows["own"]].iloc[0], np.uint64) if rows["own"].any() else np.empty(0, np.uint64)
    met = [np.frombuffer(x, np.uint64) for x in rows["fps"][~rows["own"]]]
    every = np.concatenate([own, *met])
    # nodes are small numbers in the order of the signed fingerprints, so the root of a local component is its least one
    nodes, at = np.unique(every.view(np.int64), return_inverse=True)
    label = np.arange(len(nodes))
    step = max(1, AT_ONCE // max(1, len(every)))
    for start in range(0, len(own), step):
        near = np.bitwise_count(own[start : start + step, None] ^ every[None, :]) <= RADIUS
        rows_ = np.flatnonzero(near.sum(axis=1) > 1)
        i, j = np.nonzero(near[rows_])
        _unite(label, at[start + rows_[i]], at[j])
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return pd.DataFrame({"a": nodes[linked], "b": nodes[label[linked]]})


def links(classes: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of all pairs within the radius; classes: distinct fingerprints fp."""
    tiled = classes.select("fp", *[q.alias(f"q{i}") for i, q in enumerate(_quarters(F.col("fp")))])
    sizes = tiled.groupBy("q0", "q1", "q2", "q3").agg(F.count(F.lit(1)).alias("n"))
    # at most 17^4 rows whatever the input, so a broadcast of them is bounded
    tiles = settled(sizes.select("q0", "q1", "q2", "q3", F.ceil(F.col("n") / SUB_TILE).cast("int").alias("subs")))
    quarters = ["q0", "q1", "q2", "q3"]
    dealt = tiled.join(F.broadcast(tiles), quarters)
    dealt = dealt.withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs").cast("long")).cast("int"))
    packed = settled(
        dealt.groupBy(*quarters, "sub").agg(F.collect_list("fp").alias("list"))
        .select(*quarters, "sub", F.unhex(F.array_join(F.transform("list", _little_endian), "")).alias("fps"))
    )
    ball = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(d)]) for d in _ball()])
    # the owner of a comparison is the tile at the lesser counts; n_met: sub-tiles of the largest tile that it meets
    reach = tiles.select(*quarters, F.col("subs").alias("other"), F.explode(ball).alias("d"))
    owner = [(F.col(f"q{i}") - F.col(f"d.d{i}")).alias(f"q{i}") for i in range(4)]
    most = reach.select(*owner, "other").groupBy(*quarters).agg(F.max("other").alias("n_met"))
    owners = settled(tiles.join(F.broadcast(most), quarters).select(*[F.col(q).alias(f"o{q}") for q in quarters], "subs", F.ceil(F.col("n_met") / SUB_TILES_AT_ONCE).cast("int").alias("chunks")))
    here = [F.col(q) == F.col(f"o{q}") for q in quarters]
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keep = [*[f"o{q}" for q in quarters], "osub", "chunk", "own", "fps"]
    own = packed.join(F.broadcast(owners), here).select("*", F.col("sub").alias("osub"), numbers("chunks").alias("chunk")).withColumn("own", F.lit(True))
    met = packed.select(*quarters, "sub", "fps", F.explode(ball).alias("d")).select(*owner, "sub", "fps", "d")
    met = met.join(F.broadcast(owners), here).select("*", numbers("subs").alias("osub"))
    inside = F.greatest(*[F.abs(F.col(f"d.d{i}")) for i in range(4)]) == 0
    met = met.where(~inside | (F.col("osub") < F.col("sub"))).withColumns({"chunk": F.floor(F.col("sub") / SUB_TILES_AT_ONCE).cast("int"), "own": F.lit(False)})
    cells = own.select(*keep).unionByName(met.select(*keep))
    return cells.groupBy(*[f"o{q}" for q in quarters], "osub", "chunk").applyInPandas(_links, "a long, b long").distinct()


def _little_endian(fp):
    """16 hexadecimal digits, lowest byte first."""
    digits = F.lpad(F.hex(fp), 16, "0")
    return F.concat(*[F.substring(digits, 15 - 2 * i, 2) for i in range(8)])


def _rooted(prints: DataFrame, least) -> DataFrame:
    """(fp, least, root) per distinct fingerprint; least: an aggregate over the rows of one."""
    classes = settled(prints.groupBy("fp").agg(least.alias("least")))
    roots = connected_components(links(classes.select("fp")))
    return settled(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 lowercase hex digits), component_id (smallest doc_id reachable)."""
    prints = settled(fingerprints(docs))
    rooted = _rooted(prints, F.min("doc_id"))
    smallest = settled(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    by_class = settled(rooted.join(smallest, "root").select("fp", "component_id"))
    return prints.join(by_class, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs per component, all columns: that of the smallest doc_id, a null one last, and of rows that repeat
    it that of the least digest of the text; of rows equal in both the first by a hash of all columns, as common.first_by."""
    key, hashed = (fresh(docs.columns, x) for x in ("_id_key", "_digest"))
    as_key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    prints = settled(fingerprints(docs, True))
    rooted = _rooted(prints, F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")))
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    stay = settled(first.select(as_key(F.col("first.doc_id")).alias(key), F.col("first.digest").alias(hashed)))
    # rows equal in doc_id and text share a component, so each pair of key and digest stands for one component
    left = docs.withColumns({key: as_key(F.col("doc_id").cast("long")), hashed: _digest()}).join(stay, [key, hashed], "left_semi")
    return first_by(left, [key, hashed], docs.columns)
