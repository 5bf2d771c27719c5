"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs. DataFrame and SQL functions only.

A paragraph is a line; its digest is 64 bits. The distinct digests of a text are dealt to blocks by their low bits, and
each block hashes a digest to one cell in each of its four rows; a cell has a count and the exclusive-or of digests and
of their check hashes. Subtracting two sketches cell by cell cancels what both texts have; peeling then takes pure cells
(one digest left, proved by its check hash) until none is left, which recovers the digests that differ. Where peeling
gets stuck, both sketches are made again with four times the blocks and other cells, for those documents alone, until all are
recovered.
The likeness of two fingerprints is the share of common paragraphs that follows: common / all distinct.

The fingerprint string has the number of digests, the number of blocks, and each cell's count, digest and check sums.

The next document is found without moving texts: ids alone are range-partitioned and sorted, and the ends of
partitions are joined up by a table of one row per partition.

Defined results: a null text counts as empty, and an empty text is one empty paragraph; a repeated paragraph counts once;
the next document of the last, and of rows with a null doc_id, is the first; of rows that repeat a doc_id the least text
stands for it as a next document; without any doc_id the next text is empty; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import once
from tideline.session import settled, small_table

ROWS, WIDTH = 4, 8  # cells of a block; two digests share all their cells once in WIDTH^ROWS pairs
CELLS = ROWS * WIDTH
PER_BLOCK = 7  # digests of a text by block, about
ROUNDS = 6  # of peeling
GROWTH = 2  # powers of two by which a retry is larger
RETRIES = 5  # after these the digests themselves are compared, which always succeeds

CELL = "struct<n: int, k: bigint, c: bigint>"


def digests(text: Column) -> Column:
    """Distinct paragraph digests."""
    return F.array_distinct(F.transform(F.split(text, "\n", -1), lambda p: F.xxhash64(p)))


def _check(k: Column, salt: int) -> Column:
    return F.xxhash64(k, F.lit(salt))


def _items(keys: Column, salt: int) -> Column:
    return F.transform(keys, lambda k: F.struct(k.alias("k"), _check(k, salt).alias("c")))


def block_bits(n: Column) -> Column:
    """log2 of the number of blocks for n digests."""
    return F.greatest(F.lit(0), F.ceil(F.log2(n / F.lit(float(PER_BLOCK)))).cast("int"))


def _power(bits: Column) -> Column:
    return F.pow(F.lit(2.0), bits).cast("bigint")


def _upto(n: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), n - 1)


def _positions(check: Column) -> list[Column]:
    """Index of a digest's cell in each row."""
    low = F.pmod(check, F.lit(WIDTH**ROWS)).cast("int")
    return [(F.floor(low / WIDTH**j) % WIDTH + j * WIDTH).cast("int") for j in range(ROWS)]


def _apply(cells: Column, items: Column, sign: int, count=lambda i: F.lit(1)) -> Column:
    """Cells of one block with the items added (sign 1) or taken out (-1)."""
    placed = F.transform(items, lambda i: F.struct(count(i).alias("n"), i["k"].alias("k"), i["c"].alias("c"), F.array(*_positions(i["c"])).alias("p")))

    def cell(c: Column, x: Column, put: Column) -> Column:
        row = F.floor(x / WIDTH).cast("int")

        def add(a: Column, i: Column) -> Column:
            changed = F.struct((a["n"] + F.lit(sign) * i["n"]).cast("int").alias("n"), a["k"].bitwiseXOR(i["k"]).alias("k"), a["c"].bitwiseXOR(i["c"]).alias("c"))
            return F.when(F.get(i["p"], row) == x, changed).otherwise(a)

        return F.aggregate(put, c, add)

    return once(placed, lambda put: F.transform(cells, lambda c, x: cell(c, x, put)))


def _no_cells() -> Column:
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("c"))
    return F.array_repeat(zero, CELLS)


def sketch(keys: Column, bits: Column, salt: int = 0) -> Column:
    """Cells of all blocks. Blocks are dealt in two levels, so a long text costs no square of its blocks."""
    low = F.floor(bits / 2).cast("int")

    def outer(items: Column) -> Column:
        def within(s: Column) -> Column:
            mine = F.filter(items, lambda i: F.pmod(i["k"], _power(low)) == s)

            def block(sub: Column) -> Column:
                def cells(t: Column) -> Column:
                    here = F.filter(sub, lambda i: F.floor(F.pmod(i["k"], _power(bits)) / _power(low)).cast("bigint") == t)
                    return _apply(_no_cells(), here, 1)

                return F.flatten(F.transform(_upto(_power(bits - low)), cells))

            return once(mine, block)

        return F.flatten(F.transform(_upto(_power(low)), within))

    return once(_items(keys, salt), outer)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["c"].bitwiseXOR(y["c"]).alias("c")))


def _peel_block(cells: Column, salt: int) -> Column:
    """Number of digests recovered from one block; null if peeling gets stuck."""
    state = F.struct(cells.alias("cells"), F.lit(0).alias("found"))

    def round_(s: Column, _: Column) -> Column:
        pure = F.array_distinct(F.filter(s["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["k"], salt) == c["c"])))
        taken = lambda p: F.struct(_apply(s["cells"], p, -1, lambda i: i["n"]).alias("cells"), (s["found"] + F.size(p)).alias("found"))
        return once(pure, lambda p: F.when(F.size(p) > 0, taken(p)).otherwise(s))

    clean = lambda s: F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["k"] == 0) & (c["c"] == 0))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state, round_, lambda s: F.when(clean(s), s["found"]))


def differing(a: Column, b: Column, bits: Column, salt: int = 0) -> Column:
    """Number of digests in one of two digest arrays but not in the other, by sketches of 2^bits blocks; null on failure."""
    def peel(cells: Column) -> Column:
        by_block = F.transform(_upto(_power(bits)), lambda i: _peel_block(F.slice(cells, (i * CELLS + 1).cast("int"), F.lit(CELLS)), salt))
        return F.aggregate(by_block, F.lit(0), lambda x, y: x + y)

    return once(subtract(sketch(a, bits, salt), sketch(b, bits, salt)), peel)


def written(keys: Column) -> Column:
    """The fingerprint string."""
    bits = block_bits(F.size(keys))
    cell = lambda c: F.concat(F.lpad(F.hex(c["n"]), 2, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(F.shiftrightunsigned(c["c"], 32)), 8, "0"))
    return F.concat_ws(":", F.size(keys), bits, F.lower(F.array_join(F.transform(sketch(keys, bits), cell), "")))


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def _nexts(ids: DataFrame) -> DataFrame:
    """(key, prev_key, need): each document as the next one of prev_key, which needs so many of its code points."""
    known = ids.where("doc_id is not null")
    order = settled(known.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("doc_id", "need", F.spark_partition_id().alias("part")))
    # one row per partition, a number that the session sets
    firsts = sorted(tuple(r) for r in order.groupBy("part").agg(F.min("doc_id")).collect())
    if not firsts:
        return ids.where("false").select(_key(F.col("doc_id")).alias("key"), F.lit("").alias("prev_key"), "need")
    after = [{"part": p, "first": firsts[(i + 1) % len(firsts)][1]} for i, (p, _) in enumerate(firsts)]
    ends = F.broadcast(small_table(ids.sparkSession, after, "part: int, first: bigint"))
    here = Window.partitionBy("part").orderBy("doc_id")
    linked = order.withColumn("following", F.lead("doc_id").over(here)).join(ends, "part").select("doc_id", "need", F.coalesce("following", "first").alias("next"))
    unnamed = ids.where("doc_id is null").select("doc_id", "need", F.lit(firsts[0][1]).alias("next"))
    return linked.unionByName(unnamed).select(_key(F.col("next")).alias("key"), _key(F.col("doc_id")).alias("prev_key"), "need")


def _prepared(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, n_chars, edited_sha256, and digests of the text, its edited text and the next text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(_key(F.col("doc_id")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    ids = settled(keyed.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 2)).alias("need")))
    nexts = settled(_nexts(ids))
    first = Window.partitionBy("key").orderBy("text")
    # both sides of the last join read one exchange of the texts by key; a rank here would add a step of its own before it
    others = keyed.withColumn("earlier", F.lag("key").over(first)).where("earlier is null").join(nexts, "key")
    others = others.select(F.col("prev_key").alias("key"), F.col("doc_id").alias("next_id"), F.substr(F.col("text"), F.lit(1), F.col("need").cast("int")).alias("head"), digests(F.col("text")).alias("d_next"))
    both = keyed.join(others, "key", "left")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), n - half), F.substr(F.coalesce("head", F.lit("")), F.lit(1), half))
    both = both.select("doc_id", "next_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), F.coalesce("d_next", digests(F.lit(""))).alias("d_next"))
    return settled(both.select("doc_id", "next_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digests(F.col("text")).alias("d_text"), digests(F.col("edited")).alias("d_edited"), "d_next"))


def _common_bits(a: str, b: str) -> Column:
    return F.greatest(block_bits(F.size(a)), block_bits(F.size(b)))


def _likeness(a: str, b: str, difference: str) -> Column:
    total = F.size(a) + F.size(b)
    return (total - F.col(difference)) / (total + F.col(difference))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_id."""
    pending, solved = _prepared(docs), []
    for retry in range(RETRIES + 1):
        more = F.lit(GROWTH * retry)
        by = [differing(F.col("d_text"), F.col(x), _common_bits("d_text", x) + more, retry).alias(y) for x, y in (("d_edited", "x_edited"), ("d_next", "x_next"))]
        tried = settled(pending.select(*[c for c in pending.columns if c[:2] != "x_"], *by))
        done = F.col("x_edited").isNotNull() & F.col("x_next").isNotNull()
        solved.append(tried.where(done))
        pending = tried.where(~done)
        if pending.isEmpty():
            break
    else:
        exact = [(F.size(F.array_except("d_text", x)) + F.size(F.array_except(x, "d_text"))).alias(y) for x, y in (("d_edited", "x_edited"), ("d_next", "x_next"))]
        solved.append(pending.select(*[c for c in pending.columns if c[:2] != "x_"], *exact))
    rows = solved[0]
    for part in solved[1:]:
        rows = rows.unionByName(part)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        written(F.col("d_text")).alias("fingerprint"), written(F.col("d_edited")).alias("edited_fingerprint"),
        _likeness("d_text", "d_edited", "x_edited").alias("near_edited"), _likeness("d_text", "d_next", "x_next").alias("near_next"), "next_id",
    )
