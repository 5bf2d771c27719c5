"""Token counts by a map-side two-tier lookup, without a shuffle of pre-tokens.

Texts are split into pre-tokens; a broadcast table of a bounded size has the lengths of frequent ones, and each worker
encodes the others once and keeps their lengths in a cache of a bounded size. The table comes from a bounded sample of
rows; it changes the speed and not the counts.

Defined results: a null text counts as empty (0 tokens); special strings inside a text are one token each, as the
library's default has it; rows that repeat a doc_id give one result row each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import commonest, drawn, texts
from tideline.session import settled

#: Fixed value: the byte-level splitting pattern of the published vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAMPLE_ROWS = 4096  # rows of the sample that names the frequent pre-tokens, about
LOCAL_TOP = 8192  # pre-tokens that a batch of the sample proposes
FREQUENT = 1 << 16  # entries of the broadcast table at most
CACHE = 1 << 18  # entries of a worker's cache, the table's included
LONGEST = 64  # characters of a cached pre-token; longer ones are encoded each time
LIMIT = 1024  # tokens above which over_limit is true

_split = regex.compile(PATTERN)
_workers: dict = {}


class Lengths(dict):
    """Lengths of pre-tokens: the frequent ones, then those met, until the cache is full and starts anew."""

    def __init__(self, frequent: dict[str, int], encode: Callable[[str], int]):
        super().__init__(frequent)
        self.frequent, self.encode = frequent, encode

    def __missing__(self, piece: str) -> int:
        n = self.encode(piece)
        if len(piece) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


def _library(kind: str, data: bytes) -> tuple[Callable[[str], int], bool, list[str]]:
    """Length of a text's encoding; whether PATTERN splits its texts; its special strings."""
    if kind == "model":
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=data)
        return (lambda s: len(processor.encode(s))), False, []
    from tokenizers import Tokenizer

    tokenizer, spec = Tokenizer.from_str(data.decode()), json.loads(data)
    split = spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not spec.get("normalizer")
    specials = [x["content"] for x in spec["added_tokens"]]
    plain = plain and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in spec["added_tokens"])
    return (lambda s: len(tokenizer.encode(s, add_special_tokens=False).ids)), bool(plain), specials


def counter(kind: str, data: bytes, frequent: dict[str, int]) -> Callable[[str], int]:
    encode, splits, specials = _library(kind, data)
    if not splits:
        return encode
    lengths = Lengths(frequent, encode)
    cut = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def count(text: str) -> int:
        parts = cut.split(text) if cut else [text]
        return len(parts) - 1 + sum(sum(map(lengths.__getitem__, _split.findall(p))) for p in parts)

    return count


def _frequent(docs: DataFrame, kind: str, data: bytes) -> dict[str, int]:
    encode, splits, _ = _library(kind, data)
    if not splits:
        return {}
    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch["text"]:
                seen.update(_split.findall(text or ""))
            yield pd.DataFrame(seen.most_common(LOCAL_TOP), columns=["piece", "n"])

    proposed = drawn(docs, SAMPLE_ROWS).select("text").mapInPandas(propose, "piece string, n long").where(F.length("piece") <= LONGEST)
    counted = settled(proposed.groupBy("piece").agg(F.sum("n").alias("n")))
    return {r["piece"]: encode(r["piece"]) for r in commonest(counted, "n", FREQUENT).select("piece").toLocalIterator()}


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit; path: vocabulary file, .json or .model."""
    docs, kind = texts(docs), path.rpartition(".")[2]
    with open(path, "rb") as f:  # a file of the driver's own installation; executors get its bytes
        data = f.read()
    sent = docs.sparkSession.sparkContext.broadcast((kind, data, _frequent(docs, kind, data)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = id(sent.value)
        if key not in _workers:
            _workers.clear()
            _workers[key] = (sent.value, counter(*sent.value))
        count = _workers[key][1]
        for batch in batches:
            whole = batch["text"].fillna("")
            n = [count(t) for t in whole]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_bytes": [len(t.encode()) for t in whole], "n_tokens": n, "over_limit": [x > limit for x in n]})

    return docs.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
