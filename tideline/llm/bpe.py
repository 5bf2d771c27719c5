"""Byte-level BPE encoding and decoding; words are merged by folds of Spark's higher-order functions.

Encoding. A word (pre-token) is held as an array of byte strings, at first one per byte. A higher-order fold joins the
leftmost neighbours whose joined bytes have the least rank, until no two have one; what is left are the ids. The ranks
are a literal map from bytes to rank, cut into buckets by hash, because a lookup in one large map literal is linear.

Distinct words. The fold runs over distinct words, counted in a bounded sample of rows; the commonest, at most WORDS, are
sent to the workers as a dictionary from word to ids. Every whole text is split there and looked up word by word. A word
that the dictionary lacks takes the same merges through a heap, with a bounded cache: to bring folded words back to
their texts would shuffle all texts or ids, and a very long word would cost the fold the square of its length (figures
in the README). The dictionary changes the speed and not the ids; neither texts nor words are shuffled for encoding.

Decoding looks up each id's bytes and concatenates the binary pieces.

Literals are session variables, so that plans name them and don't print them.

Defined results: a null text counts as empty (no ids); special strings are ordinary text; rows that repeat a doc_id
give one result row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import commonest, drawn, once, texts
from tideline.session import settled

BUCKETS = 1 << 15  # of the literal rank map
WORDS = 1 << 18  # of the dictionary at most, some 10 MB
SAMPLE_ROWS = 40_000  # rows that name the dictionary's words, about
LONG = 64  # characters of a dictionary word, or of a cached one, at most
NONE = (1 << 31) - 1  # rank of bytes that have none
CACHE = 1 << 18  # words of a worker's cache besides the dictionary
AT_ONCE = 1 << 22  # characters of the texts that a worker gives back at once, about

_names = itertools.count()
_workers: dict = {}


#: Code points that became letters or numbers after the Unicode version of Java 17 (13), as in Unicode 16.
LATER_LETTERS = """870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 1C89-1C8A 2C2F 2C5F 9FFD-9FFF A7C0-A7C1 A7CB-A7CD A7D0-A7D1 A7D3
A7D5-A7DC A7F2-A7F4 10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC
105C0-105F3 10780-10785 10787-107B0 107B2-107BA 10D4A-10D65 10D6F-10D85 10EC2-10EC4 10F70-10F81 11071-11072 11075
1123F-11240 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3 11740-11746 11AB0-11ABF 11BC0-11BE0 11F02 11F04-11F10
11F12-11F33 12F90-12FF0 1342F 13441-13446 13460-143FA 16100-1611D 16A70-16ABE 16D40-16D6C 18CFF 1AFF0-1AFF3 1AFF5-1AFFB
1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D 1E290-1E2AD 1E4D0-1E4EB 1E5D0-1E5ED 1E5F0
1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE 2A6DE-2A6DF 2B735-2B739 2EBF0-2EE5D 31350-323AF"""
LATER_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 11F50-11F59 16130-16139 16AC0-16AC9 16D70-16D79 1CCF0-1CCF9 1D2C0-1D2D3 1E4F0-1E4F9 1E5F1-1E5FA"


#: Code points that the workers' matcher counts as letters or numbers (Unicode 17) and the library doesn't yet.
NEWER_LETTERS = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20
18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE
1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"""
NEWER_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Pre-tokens of a text as the library has them; texts with a newer letter or number take a pattern that leaves it out."""
    as_set = lambda ranges: "[" + "".join("-".join(rf"\U{int(end, 16):08X}" for end in r.split("-")) for r in ranges.split()) + "]"
    letters, numbers = as_set(NEWER_LETTERS), as_set(NEWER_NUMBERS)
    newer = as_set(f"{NEWER_LETTERS} {NEWER_NUMBERS}")
    parts = [p.replace(r"\p{L}", rf"(?:(?!{letters})\p{{L}})").replace(r"\p{N}", rf"(?:(?!{numbers})\p{{N}})") for p in pattern.split(r"[^\s\p{L}\p{N}]")]
    exact = regex.compile(rf"(?:[^\s\p{{L}}\p{{N}}]|{newer})".join(parts)).findall
    plain, found = regex.compile(pattern).findall, regex.compile(newer).search
    return lambda text: plain(text) if text.isascii() or not found(text) else exact(text)


def _with_later(name: str, ranges: str) -> str:
    """A category with its later code points, which are asked for beyond U+086F only."""
    later = "".join("-".join(rf"\x{{{end}}}" for end in r.split("-")) for r in ranges.split())
    return rf"\p{{{name}}}[\x{{870}}-\x{{323AF}}&&[{later}]]"


def jvm_pattern(pattern: str) -> str:
    """The splitting pattern for Java's matcher, with white space, letters and numbers as the library has them."""
    letters, numbers = _with_later("L", LATER_LETTERS), _with_later("N", LATER_NUMBERS)
    others = rf"[^\s{letters}{numbers}]"
    return "(?U)" + others.join(p.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]") for p in pattern.split(r"[^\s\p{L}\p{N}]"))


def merge_all(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the leftmost pair of least rank first, by a heap."""
    if word in ranks:
        return [ranks[word]]
    return merge_pieces(word, ranks)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of base64 pieces and ranks, in the driver's own installation."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _bucket(piece: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(buckets)).cast("int")


def _literal(spark: SparkSession, df: DataFrame, names: list[str]) -> list[Column]:
    """The columns of df's one row as literals."""
    view = f"tideline_literals_{next(_names)}"
    df.createOrReplaceTempView(view)
    kinds = dict(df.dtypes)
    for n in names:
        spark.sql(f"DECLARE OR REPLACE VARIABLE {view}_{n} {kinds[n]}")
        spark.sql(f"SET VAR {view}_{n} = (SELECT {n} FROM {view})")
    spark.catalog.dropTempView(view)
    return [F.expr(f"system.session.{view}_{n}") for n in names]


def _map_literal(spark: SparkSession, pairs: DataFrame, buckets: int) -> Column:
    """(k, v) rows as an array of small maps, by hash of the key; `buckets` entries in one row, whatever the corpus."""
    full = pairs.groupBy(_bucket(F.col("k"), buckets).alias("b")).agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m"))
    none = F.create_map().cast(dict(full.dtypes)["m"])
    every = spark.range(buckets).select(F.col("id").cast("int").alias("b")).join(full, "b", "left").select("b", F.map_entries(F.coalesce("m", none)).alias("m"))
    one = every.agg(F.array_sort(F.collect_list(F.struct("b", "m"))).alias("l")).select(F.transform("l", lambda x: F.map_from_entries(x["m"])).alias("v"))
    return _literal(spark, settled(one), ["v"])[0]


class Codec:
    """A vocabulary's literals, and the expressions over them."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int], pattern: str):
        self.spark, self.ranks, self.pattern = spark, ranks, pattern
        # columns by Arrow: rows of Python objects would cost the driver ten times the memory
        listed = pa.table({"k": pa.array(ranks, pa.binary()), "v": pa.array(ranks.values(), pa.int32())})
        self.buckets = _map_literal(spark, spark.createDataFrame(listed), BUCKETS)
        self.by_rank: Column | None = None

    def words(self, text: Column) -> Column:
        """Pre-tokens of a text, in order."""
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(jvm_pattern(self.pattern)), F.lit(0))

    def rank(self, piece: Column) -> Column:
        """The rank of some bytes, NONE where the vocabulary lacks them."""
        return F.coalesce(F.try_element_at(F.get(self.buckets, _bucket(piece, BUCKETS)), piece), F.lit(NONE))

    def fold(self, word: Column) -> Column:
        """Ids of one word by ranked merges over its bytes."""

        def merge(s: Column, _: Column) -> Column:
            pieces = s["pieces"]
            state = lambda p, done: F.struct(p.alias("pieces"), F.lit(done).alias("done"))

            def joined(ranks: Column) -> Column:
                def at(i: Column) -> Column:
                    pair = F.array(F.concat(F.get(pieces, i - 1), F.get(pieces, i)))
                    return state(F.concat(F.slice(pieces, F.lit(1), i - 1), pair, F.slice(pieces, i + 2, F.size(pieces))), False)

                return once(F.array_min(ranks), lambda least: F.when(least == NONE, state(pieces, True)).otherwise(once(F.array_position(ranks, least).cast("int"), at)))

            pairs = F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda i: self.rank(F.concat(F.get(pieces, i - 1), F.get(pieces, i))))
            return F.when(s["done"] | (F.size(pieces) < 2), s).otherwise(once(pairs, joined))

        def folded(data: Column) -> Column:
            bytes_ = F.transform(F.sequence(F.lit(1), F.length(data)), lambda i: F.substring(data, i, F.lit(1)))
            start = F.struct(bytes_.alias("pieces"), F.lit(False).alias("done"))
            merged = F.aggregate(F.sequence(F.lit(1), F.length(data)), start, merge, lambda s: F.transform(s["pieces"], self.rank))
            # a whole word of the vocabulary is one id, even where merges don't lead to it
            return once(self.rank(data), lambda whole: F.when(whole != NONE, F.array(whole)).otherwise(merged))

        return once(F.encode(word, "UTF-8"), folded)

    def learn(self, docs: DataFrame) -> pa.Table:
        """The dictionary: (word, ids) of the commonest words of a sample by the fold, WORDS at most; ids as `packed`."""
        words = drawn(docs, SAMPLE_ROWS).select(F.explode(self.words(F.col("text"))).alias("word")).where(F.length("word") <= LONG)
        counted = settled(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
        # rows are dealt anew, as those of few words may lie in few partitions
        few = commonest(counted, "n", WORDS).select("word").repartition(F.col("word"))
        return few.select("word", self.packed(self.fold(F.col("word"))).alias("ids")).toArrow()

    def close(self) -> None:
        """Drop the variables; plans that were made with them keep their values."""
        for c in (self.buckets, self.by_rank):
            if c is not None:
                self.spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {c._jc.toString()}")

    def decoded(self, ids: Column) -> Column:
        """Bytes of a list of ids; an id that the vocabulary lacks gives null."""
        if self.by_rank is None:
            pieces = {r: p for p, r in self.ranks.items()}
            every = pa.array(range(max(pieces, default=-1) + 1), pa.int32())
            table = pa.table({"i": every, "p": pa.array([pieces.get(i, b"").hex() for i in range(len(every))], pa.string())})
            one = self.spark.createDataFrame(table).agg(F.array_sort(F.collect_list(F.struct("i", "p"))).alias("l")).select(F.col("l.p").alias("v"))
            self.by_rank = _literal(self.spark, settled(one), ["v"])[0]
        known = F.forall(ids, lambda i: (i >= 0) & (i < F.size(self.by_rank)))
        return F.when(known, F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.by_rank, i)), "")))

    def packed(self, ids: Column) -> Column:
        """Ids as little-endian unsigned 32-bit integers."""
        digits = lambda i: F.lpad(F.hex(i), 8, "0")
        code = lambda d: F.concat(*[F.substring(d, 7 - 2 * k, 2) for k in range(4)])
        return F.unhex(F.array_join(F.transform(ids, lambda i: once(digits(i), code)), ""))

    def unpacked(self, data: Column) -> Column:
        """Ids of `packed`, as an array."""
        part = lambda i: F.reverse(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda j: F.hex(F.substring(data, 4 * i + j, 1))))
        numbers = F.transform(F.sequence(F.lit(0), (F.length(data) / 4).cast("int") - 1), lambda i: F.conv(F.array_join(part(i), ""), 16, 10).cast("int"))
        return F.when(F.length(data) == 0, F.array().cast("array<int>")).otherwise(numbers)


def merge_pieces(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same without asking for the whole word first."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the piece that starts at i
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    live = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if live[i] else n
        if j >= n or end[j] != stop:
            continue  # one of the two has merged with another since
        end[i], live[j] = stop, False
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:stop])) is not None:
            heapq.heappush(heap, (r, h, stop))
    return [ranks[word[i : end[i]]] for i in range(n) if live[i]]


class Words(dict):
    """Ids of words, packed: those of the dictionary, then those met, until the cache is full and starts anew."""

    def __init__(self, known: pa.Table, ranks: dict[bytes, int]):
        super().__init__(zip(known["word"].to_pylist(), known["ids"].to_pylist(), strict=True))
        self.known, self.ranks, self.most = known, ranks, len(self) + CACHE

    def __missing__(self, word: str) -> bytes:
        ids = np.array(merge_all(word.encode(), self.ranks), "<u4").tobytes()
        if len(word) <= LONG:
            if len(self) >= self.most:
                self.clear()
                self.update(zip(self.known["word"].to_pylist(), self.known["ids"].to_pylist(), strict=True))
            self[word] = ids
        return ids


def encode(docs: DataFrame, codec: Codec) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and decoded (bytes of these ids)."""
    docs = texts(docs)
    pattern = codec.pattern
    # WORDS entries of LONG characters at most, and the vocabulary: a bounded broadcast
    sent = codec.spark.sparkContext.broadcast((codec.ranks, codec.learn(docs)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = id(sent.value)
        if key not in _workers:  # it lives as long as the worker works on this query
            _workers.clear()
            ranks, known = sent.value
            _workers[key] = (sent.value, Words(known, ranks), {r: p for p, r in ranks.items()})
        _, words, pieces = _workers[key]
        split = splitter(pattern)

        def result(rows: pd.DataFrame) -> pd.DataFrame:
            ids = [b"".join([words[w] for w in split(t)]) for t in rows["text"]]
            decoded = [b"".join([pieces[i] for i in np.frombuffer(x, "<u4").tolist()]) for x in ids]
            return pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": decoded})

        for batch in batches:
            batch["text"] = batch["text"].fillna("")
            part = (batch["text"].str.len().cumsum() // AT_ONCE).to_numpy()
            for p in np.unique(part):
                yield result(batch[part == p])

    return docs.mapInPandas(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    codec = Codec(docs.sparkSession, read_ranks(path), pattern)
    out = encode(docs, codec).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    codec.close()
    return out
