"""Language identification by prediction by partial matching.

Per language a byte context tree of orders 0 to 3 holds symbol counts, frozen after learning. A symbol seen n times in a
context with T symbols of D kinds costs -log2(n / (T + D)) bits; one not seen there costs the escape -log2(D / (T + D))
and is coded in the next shorter context, in the end uniformly over 256 bytes. A context that a language never saw is
passed over at no cost. As the statistics are frozen, the cost of each gram (context and byte) that any language has is
tabled once for all languages, escapes included; a text's exact code length is a sum of such costs over all of its
bytes. Nothing is pruned. The language of the least code length wins.

Learning takes a bounded sample of rows per language; scoring takes every byte of every text. A-Z count as a-z. More than
MOST_LANGUAGES names of languages are an error, as the model is held in memory.

Defined results: `und` and score 0 for a null text, one without a letter, or where nothing could be learned; ties go to
the first name; rows that repeat a doc_id give one result row each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import fold, share, texts
from tideline.session import settled

ORDER = 3
SAMPLE_ROWS = 500  # rows of each language to learn from, about
LEAST = 1  # occurrences of a gram that is kept: all are
MOST_LANGUAGES = 1000  # more names in `lang` are an error
AT_ONCE = 1 << 18  # bytes scored by one numpy call

_letter = regex.compile(r"\p{L}")
_start = b" " * ORDER


def gram_counts(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order k: the codes of runs of k + 1 bytes, and their counts."""
    data = np.frombuffer(_start + text.encode().lower(), np.uint8).astype(np.uint32)
    out, code = [], np.zeros(len(data) - ORDER, np.uint32)
    for k in range(ORDER + 1):
        code = code | (data[ORDER - k : len(data) - k] << np.uint32(8 * k))
        out.append(np.unique(code, return_counts=True))
    return out


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, rows in batch.groupby("lang"):
            for k, (codes, counts) in enumerate(gram_counts("\n".join(rows["text"]))):
                yield pd.DataFrame({"lang": lang, "k": k, "code": codes.astype(np.int64), "n": counts})


class Model:
    """By order: the codes of grams that any language has with their costs by language, and of contexts with their escapes.

    Its size is that of the sample's different grams times the languages, 4 bytes each.
    """

    def __init__(self, counts: pd.DataFrame):
        """counts: lang, k, code, n; code holds the symbol in its lowest byte and the context above it."""
        self.langs = sorted(counts["lang"].unique())
        self.grams, self.costs, self.contexts, self.escapes = [], [], [], []
        lang = counts["lang"].map({x: i for i, x in enumerate(self.langs)}).to_numpy(np.int64)
        k, code, n = (counts[c].to_numpy(np.int64) for c in ("k", "code", "n"))
        for order in range(ORDER + 1 if self.langs else 0):
            mine = k == order
            grams, gram = np.unique(code[mine], return_inverse=True)
            contexts, context = np.unique(grams >> 8, return_inverse=True)
            count = np.zeros((len(grams), len(self.langs)))
            np.add.at(count, (gram, lang[mine]), n[mine])
            total, kinds = (np.zeros((len(contexts), len(self.langs))) for _ in range(2))
            np.add.at(total, context, count)
            np.add.at(kinds, context, count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0)
                seen = np.log2((total + kinds)[context] / count)
            cost = np.where(count > 0, seen, escape[context] + self._costs(grams.astype(np.uint32), order - 1))
            self.grams.append(grams.astype(np.uint32))
            self.costs.append(cost.astype(np.float32))
            self.contexts.append(contexts.astype(np.uint32))
            self.escapes.append(escape.astype(np.float32))

    @staticmethod
    def _find(sorted_: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each code is, and whether it is there at all."""
        at = np.minimum(np.searchsorted(sorted_, asked), max(0, len(sorted_) - 1))
        return at, (sorted_[at] == asked) if len(sorted_) else np.zeros(len(asked), bool)

    def _steps(self, codes: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(which of the codes, what they cost by language), from the order down; what no order has costs 8 bits."""
        left = np.arange(len(codes))
        for k in range(order, -1, -1):
            code = codes[left] & np.uint32((1 << 8 * (k + 1)) - 1)
            at, there = self._find(self.grams[k], code)
            yield left[there], self.costs[k][at[there]]
            left, code = left[~there], code[~there]
            at, there = self._find(self.contexts[k], code >> np.uint32(8))
            yield left[there], self.escapes[k][at[there]]
        yield left, np.full((len(left), len(self.langs)), 8, np.float32)

    def _costs(self, codes: np.ndarray, order: int) -> np.ndarray:
        out = np.zeros((len(codes), len(self.langs)))
        for which, cost in self._steps(codes, order):
            out[which] += cost
        return out

    def bits(self, text: str) -> np.ndarray:
        """Code length of the whole text by language."""
        data = np.frombuffer(_start + text.encode().lower(), np.uint8)
        total = np.zeros(len(self.langs))
        for start in range(0, len(data) - ORDER, AT_ONCE):
            part = data[start : start + AT_ONCE + ORDER].astype(np.uint32)
            codes = part[ORDER:].copy()
            for i in range(1, ORDER + 1):
                codes |= part[ORDER - i : len(part) - i] << np.uint32(8 * i)
            for _, cost in self._steps(codes, ORDER):
                total += cost.sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or text is None or not _letter.search(text):
            return "und", 0.0
        bits = self.bits(text)
        best = int(np.argmin(bits))
        return self.langs[best], float(1 / np.exp2(np.clip(bits[best] - bits, -1000, 0)).sum())


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of the languages of docs (doc_id, text, lang), from rows that aren't held out."""
    known = texts(docs, F.col("lang").cast("string").alias("lang")).where((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = settled(known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")))
    if (names := rows.count()) > MOST_LANGUAGES:
        raise ValueError(f"{names} names of languages; {MOST_LANGUAGES} can be told apart")
    # MOST_LANGUAGES rows at most, so this broadcast is bounded
    parts = F.broadcast(rows.select("lang", F.least(F.lit(1.0), F.lit(float(sample_rows)) / F.col("rows")).alias("part")))
    # rows are drawn by doc_id and text, and those equal in both count once: repeated ids or texts can't come all together
    chosen = known.withColumn("hashed", F.xxhash64("text")).join(parts, "lang").where(share(F.struct("doc_id", "hashed"), F.col("part")))
    sample = chosen.dropDuplicates(["lang", "doc_id", "hashed"]).select("lang", "text")
    counts = sample.mapInPandas(_counted, "lang string, k int, code long, n long").groupBy("lang", "k", "code").agg(F.sum("n").alias("n"))
    return Model(counts.where(F.col("n") >= LEAST).toPandas().sort_values(["lang", "k", "code"], ignore_index=True))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score (posterior of the best language under equal priors)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sent.value.predict(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]})

    rows = texts(docs, (fold(F.col("doc_id")) == 0).alias("held_out"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")
