"""What several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import fresh

FOLDS = 5  # crc32(doc_id as text) modulo this is 0 for held-out rows


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo FOLDS; a null doc_id counts as the empty text (fold 0, held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text, cast, with further columns as they are; other columns go."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def first_by(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Of rows with equal keys, the one whose columns have the least hash (of their values as text); rows that tie in it
    are equal in all columns but for collisions of 64 bits."""
    order, at = (fresh(df.columns, x) for x in ("_order", "_row"))
    hashed = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if kind[:3] in ("map", "var") else F.col(f"`{c}`") for c, kind in df.select(*[F.col(f"`{c}`") for c in columns]).dtypes])
    one = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(order, hashed).withColumn(at, F.row_number().over(one)).where(F.col(at) == 1).select(*[F.col(f"`{c}`") for c in columns])


def share(key: Column, part: Column | float) -> Column:
    """True for about that share of the rows, by a hash of the key: the same rows each time."""
    return F.pmod(F.xxhash64(key, F.lit("share")), F.lit(1 << 20)) < part * F.lit(1 << 20)


def drawn(df: DataFrame, rows: int) -> DataFrame:
    """About that many rows, or all if there are no more. Each row is drawn by itself, so that rows that repeat an id or a
    text can't come all together; for samples that change the speed of something and not its result."""
    total = df.count()
    return df if total <= rows else df.where(F.rand(0) < rows / total)


def commonest(counted: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of the largest counts, `most` of them at most; rows of one count come together or not at all."""
    held, least = 0, 1
    for r in counted.groupBy(n).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc(n)).toLocalIterator():
        held += r["rows"]  # kinds of counts: some thousand, as a sample is bounded
        if held > most:
            least = r[n] + 1
            break
    return counted.where(F.col(n) >= least)


def once(value: Column, f) -> Column:
    """f(value), with value evaluated once however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))
