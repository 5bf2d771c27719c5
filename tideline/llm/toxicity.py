"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Learning. A bounded sample of labelled rows outside the held-out fold gives (a) a lexicon: words, and word beginnings of
4 to 6 letters, that are much commoner in toxic than in other texts; (b) dense features of each text: lexicon
densities, second-person words and lexicon words near them, capitals, punctuation, obfuscation; (c) trees over these.
Features of a learning row use the lexicon of the other half of the rows, so that the trees learn how far an unseen
text's hits can be trusted. Calibration is isotonic regression over out-of-fold margins.

Scoring runs over every whole text; labels, lang, source and doc_id are no inputs of a score.

Defined results: a null or empty text is scored by its features (all zero); where no labelled rows, or those of one label only, were found,
every score is the share of that label; a doc_id with several labels is toxic if any of them is 1; null labels are ignored; rows
that repeat a doc_id give one result row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import fold, share, texts
from tideline.session import settled

SAMPLE_ROWS = 16_000  # labelled rows to learn from, at most about
LEXICON = 1024  # entries at most
LEAST_ODDS = 2.0  # log odds ratio of an entry
LEAST_ROWS = 3  # toxic rows of an entry
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_HESSIAN = 60, 3, 32, 0.15, 1.0, 1.0
FOLDS_OUT = 4  # of the margins that calibration uses
NEAR = 4  # words between a lexicon word and a second-person one
STEMS = (4, 5, 6)

#: Second-person words of some languages.
SECOND = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine euch ihr usted ustedes tú ti tus vosotros".split())

_word = re.compile(r"[^\W\d_]+")
_shout = re.compile(r"\b[A-Z]{3,}\b")
_masked = re.compile(r"[^\W\d_][0-9@$*!]+[^\W\d_]")
_kinds = np.zeros(256, np.int64)
_kinds[ord("A") : ord("Z") + 1] = 1
_kinds[ord("!")] = 2
_kinds[[ord(c) for c in "@$*"]] = 3
_kinds[ord("0") : ord("9") + 1] = 4
_kinds[[ord(c) for c in "\"#%&'()+,-./:;<=>?[\\]^_`{|}~"]] = 5


def entries(text: str) -> set[str]:
    """What a text may add to the lexicon: its words and, marked by a star, their beginnings."""
    words = {w for w in set(_word.findall(text.lower())) if len(w) > 2}
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def choose(counts: list[tuple[str, int, int]], toxic: int, other: int) -> dict[str, float]:
    """Lexicon from (entry, toxic rows, other rows); an entry's weight is its log odds ratio, shrunk where it is rare."""
    found = {}
    for entry, yes, no in counts:
        odds = np.log((yes + 0.5) / (toxic + 1)) - np.log((no + 0.5) / (other + 1))
        if yes >= LEAST_ROWS and odds >= LEAST_ODDS:
            found[entry] = (float(odds) * yes / (yes + 4), yes)
    best = sorted(found, key=lambda e: (-found[e][0] * np.sqrt(found[e][1]), e))[:LEXICON]
    return {e: found[e][0] for e in best}


class Lexicon:
    def __init__(self, weights: dict[str, float]):
        self.words = {e: w for e, w in weights.items() if e[-1] != "*"}
        self.stems = {e[:-1]: w for e, w in weights.items() if e[-1] == "*"}
        # of a stem that goes on, only the shortest is asked first
        self.heads = {s[: STEMS[0]] for s in self.stems}

    def weight(self, word: str) -> float:
        best = self.words.get(word, 0.0)
        for n in STEMS:
            best = max(best, self.stems.get(word[:n], 0.0) if len(word) >= n else 0.0)
        return best


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    text = text or ""
    words = _word.findall(text.lower())
    n, chars = max(1, len(words)), max(1, len(text))
    known, heads, head = lexicon.words, lexicon.heads, STEMS[0]
    hits = [i for i, w in enumerate(words) if w in known or w[:head] in heads]
    weights = [(i, x) for i in hits if (x := lexicon.weight(words[i]))]
    second = [i for i, w in enumerate(words) if w in SECOND]
    near = 0
    if weights and second:
        at = np.searchsorted(second, [i for i, _ in weights])
        place = np.array([-NEAR * 9, *second, 1 << 60])
        spots = np.array([i for i, _ in weights])
        near = int(((np.minimum(spots - place[at], place[at + 1] - spots)) <= NEAR).sum())
    kinds = np.bincount(_kinds[np.frombuffer(text.encode(), np.uint8)], minlength=6) if text else np.zeros(6)
    total = sum(x for _, x in weights)
    different: dict[str, float] = {words[i]: x for i, x in weights}
    masked = len(_masked.findall(text)) if kinds[2] + kinds[3] + kinds[4] else 0
    shouted = len(_shout.findall(text)) if kinds[1] > 2 else 0
    return [
        total / n,
        np.log1p(total),
        len(weights) / n,
        np.log1p(len(weights)),
        sum(different.values()),
        max(different.values(), default=0.0),
        len(second) / n,
        near / n,
        kinds[1] / chars,
        shouted / n,
        kinds[2] / chars,
        kinds[5] / chars,
        (kinds[3] + masked) / n,
    ]


class Trees:
    """Boosted regression trees of one depth for the logistic loss, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        share_ = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(share_ / (1 - share_))), []
        binned, margin = self._binned(x), np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(binned, p - y, p * (1 - p))
            margin += self._leaf(tree, binned)
            self.trees.append(tree)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple:
        """(feature, bin) of each inner node in heap order, and the values of the leaves."""
        node, splits = np.zeros(len(x), np.int64), []
        for depth in range(DEPTH):
            best = [(0.0, 0, BINS)] * (1 << depth)  # no gain: all rows go left
            for j in range(x.shape[1]):
                cell = node * (BINS + 1) + x[:, j]
                gs, hs = (np.bincount(cell, v, minlength=(BINS + 1) << depth).reshape(1 << depth, -1).cumsum(axis=1) for v in (g, h))
                left_g, left_h = gs[:, :-1], hs[:, :-1]
                all_g, all_h = gs[:, -1:], hs[:, -1:]
                gain = left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g**2 / (all_h + RIDGE)
                gain[(left_h < LEAST_HESSIAN) | (all_h - left_h < LEAST_HESSIAN)] = 0
                for k, b in enumerate(gain.argmax(axis=1)):
                    if gain[k, b] > best[k][0] + 1e-9:
                        best[k] = (float(gain[k, b]), j, int(b))
            splits.append([(j, b) for _, j, b in best])
            features_, bins = (np.array([s[i] for s in splits[-1]]) for i in (0, 1))
            node = 2 * node + (x[np.arange(len(x)), features_[node]] > bins[node])
        sums, weights = (np.bincount(node, v, minlength=1 << DEPTH) for v in (g, h))
        return splits, -RATE * sums / (weights + RIDGE)

    def _leaf(self, tree: tuple, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for level in tree[0]:
            features_, bins = (np.array([s[i] for s in level]) for i in (0, 1))
            node = 2 * node + (x[np.arange(len(x)), features_[node]] > bins[node])
        return tree[1][node]

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned, out = self._binned(x), np.full(len(x), self.base)
        for tree in self.trees:
            out += self._leaf(tree, binned)
        return out


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit of y by margin (pool adjacent violators)."""
    at, where = np.unique(margin, return_inverse=True)
    weight, total = np.bincount(where).astype(float), np.bincount(where, y)
    blocks: list[list[float]] = []
    for x, w, t in zip(at, weight, total, strict=True):
        blocks.append([x, x, w, t])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    return np.array([x for b in blocks for x in b[:2]]), np.array([b[3] / b[2] for b in blocks for _ in range(2)])


class Model:
    def __init__(self, weights: dict[str, float], x: np.ndarray, y: np.ndarray):
        self.lexicon, self.share = Lexicon(weights), float(y.mean()) if len(y) else 0.0
        self.trees = None
        if 0 < self.share < 1:
            self.trees = Trees(x, y)
            out, part = np.zeros(len(y)), np.arange(len(y)) % FOLDS_OUT
            for k in range(FOLDS_OUT):
                rest = part != k
                if 0 < y[rest].mean() < 1:
                    out[~rest] = Trees(x[rest], y[rest]).margin(x[~rest])
            self.knots, self.values = isotonic(out, y)

    def score(self, column: pd.Series) -> np.ndarray:
        if self.trees is None:
            return np.full(len(column), self.share)
        x = np.array([features(t, self.lexicon) for t in column], float).reshape(len(column), -1)
        return np.clip(np.interp(self.trees.margin(x), self.knots, self.values), 0, 1) if len(column) else np.empty(0)


def _sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of each side and label with an entry; the entry '' counts the rows."""
    for batch in batches:
        seen: Counter = Counter()
        for text, toxic, side in zip(batch["text"], batch["toxic"], batch["side"], strict=True):
            for e in entries(text or "") | {""}:
                seen[e, side, toxic] += 1
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["entry", "side", "toxic", "n"])


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic)."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0))
    part = min(1.0, sample_rows / max(1, known.count()))
    chosen = known.where(share(F.col("doc_id"), part)).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    # some sample_rows rows whatever the input, so this broadcast is bounded
    met = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(chosen), "doc_id").count()
    rows = texts(docs).join(F.broadcast(chosen), "doc_id").withColumn("hashed", F.xxhash64("text", F.lit("side")))
    # more only where rows repeat a doc_id; different texts are then drawn each by itself, and equal ones count once
    rows = rows.where(share(F.col("hashed"), min(1.0, sample_rows / max(1, met)))).dropDuplicates(["hashed", "toxic"])
    rows = rows.select("text", "toxic", F.pmod(F.col("hashed"), F.lit(2)).cast("int").alias("side"))
    rows = settled(rows)
    counted = rows.mapInPandas(_sides, "entry string, side int, toxic int, n long").groupBy("entry").agg(
        *[F.sum(F.when((F.col("side") == s) & (F.col("toxic") == t), F.col("n")).otherwise(0)).alias(f"n{s}{t}") for s in (0, 1) for t in (0, 1)]
    )
    counted = settled(counted)
    total = counted.where("entry = ''").first()
    if total is None:
        return Model({}, np.zeros((0, 1)), np.zeros(0))
    _, n00, n01, n10, n11 = total
    # what can be in one of the three lexicons below: few words, whatever the sample
    given = [("n11", "n10", n11, n10), ("n01", "n00", n01, n00), ("n01 + n11", "n00 + n10", n01 + n11, n00 + n10)]
    fits = [F.expr(f"{y} >= {LEAST_ROWS} and ln(({y} + 0.5d) / {a + 1}d) - ln(({o} + 0.5d) / {b + 1}d) >= {LEAST_ODDS - 1e-6}d") for y, o, a, b in given]
    counts = sorted(tuple(r) for r in counted.where(fits[0] | fits[1] | fits[2]).where("entry != ''").collect())
    other_side = [
        choose([(e, c, d) for e, _, _, d, c in counts], n11, n10),  # for side 0, from side 1
        choose([(e, b, a) for e, a, b, _, _ in counts], n01, n00),
    ]
    both = choose([(e, b + c, a + d) for e, a, b, d, c in counts], n01 + n11, n00 + n10)
    sent = spark.sparkContext.broadcast([Lexicon(w) for w in other_side])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [features(t, sent.value[s]) for t, s in zip(batch["text"], batch["side"], strict=True)]
            yield pd.DataFrame({"x": x, "toxic": batch["toxic"]})

    dense = rows.mapInPandas(run, "x array<double>, toxic int").toPandas()
    x = np.array(dense["x"].tolist(), float).reshape(len(dense), -1)
    order = np.lexsort([*x.T, dense["toxic"].to_numpy()])  # the model must not hang on the order of partitions
    order = order[np.random.default_rng(0).permutation(len(order))]
    return Model(both, x[order], dense["toxic"].to_numpy(float)[order])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            s = sent.value.score(batch["text"])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": s, "predicted": (s >= 0.5).astype(int)})

    rows = texts(docs, (fold(F.col("doc_id")) == 0).alias("held_out"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that aren't predicted toxic, all columns."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    @F.pandas_udf("double")
    def toxic(text: pd.Series) -> pd.Series:
        return pd.Series(sent.value.score(text))

    return docs.where(toxic(F.col("text").cast("string")) < 0.5)
