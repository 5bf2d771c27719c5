"""Mixing a corpus to target weights of its domains, with soft membership.

The labels table names three domains: toxic (toxic = 1), clean (quality = 1) and poor (quality = 0). A naive Bayes
classifier over binned text features, counted from all labelled rows, gives each document a posterior p over them. One of
the features counts a text's different words of a lexicon: words much commoner in toxic rows than in others, learned from a
bounded share of the labelled rows; its bins are counted from the others, so that they show what unseen texts have. A
document with n tokens and rate r adds r * n * p[k] expected tokens to domain k; projected gradient descent with
momentum finds rates, nonnegative and at most `upper`, whose totals T[k] fit the targets t[k] in least squares, weighted by
1 / (tokens of k), starting from rate 1 and moving each rate in the metric of its document's tokens.

In that metric a rate depends on p alone. Posteriors are stated in steps of 1/32, so documents are first summed by
posterior into a table of at most some hundred rows, whatever the corpus. The rounds are a fold over that table, a hundred
to a job; the driver sees the K totals and nothing else. Everything is DataFrame and SQL functions.

The descent ends when every total is within TOLERANCE of the budget from its target, or when the projected gradient
vanishes, as no rates come closer to the targets then; targets that are missed are logged as a warning.

Defined results: a null text counts as empty (0 tokens, the posterior of its features); a document without tokens has
rate 1 like any other of its posterior; without labelled rows the posterior is uniform, and without words for a lexicon
that feature is left out; null labels are ignored, and a
doc_id with several labels counts with each; rows that repeat a doc_id give one result row each; an empty table gives no
rows; other columns are ignored or, in `mixed`, kept.
"""

from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import once, share
from tideline.session import settled

DOMAINS = ("clean", "poor", "toxic")
TARGETS = (0.88, 0.06, 0.06)
STEPS = 32  # of a posterior
BINS = 12  # of a feature
LEXICON = 512  # words of the lexicon at most
LEXICON_ROWS = 16_000  # labelled ids that it is learned from, about, and half of them at most
LEAST_ODDS, LEAST_ROWS = 3.0, 3  # log odds ratio and toxic rows of a word of the lexicon
TOLERANCE = 1e-3  # of the budget, by which a total may miss its target
STILL = 1e-7  # of the budget: tokens by which the projected gradient moves where no rates come closer
ROUNDS, ROUNDS_AT_ONCE = 100_000, 100  # a descent that long is cut off with a warning; rounds of one job
_log = logging.getLogger(__name__)
SPACE = r"[^\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(text, F.lit(SPACE)).cast("long")


def _log_bin(value: Column, least: float, most: float) -> Column:
    """Bin of a share or size on a logarithmic scale; 0: nothing."""
    steps = (F.ln(F.greatest(value, F.lit(1e-9))) - np.log(least)) / ((np.log(most) - np.log(least)) / (BINS - 2))
    return F.when(value <= 0, 0).otherwise(F.least(F.lit(BINS - 1), F.greatest(F.lit(1), F.floor(steps).cast("int") + 2))).cast("int")


def _letters(text: Column) -> Column:
    """Lower-cased runs of letters."""
    return F.split(F.lower(text), r"[^\p{L}]+")


def features(text: Column, lexicon: list[str]) -> Column:
    """Bins of a text's dense features, array<int>; that of the lexicon is left out where it is empty."""
    hits = [F.least(F.lit(BINS - 1), F.size(F.array_distinct(F.filter(_letters(text), lambda w: w.isin(lexicon)))))] if lexicon else []
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.greatest(tokens(text), F.lit(1)).cast("double")
    count = lambda p: F.regexp_count(text, F.lit(p))
    return F.array(
        _log_bin((F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))) / words, 1e-3, 1.0),
        _log_bin(count(r"[*$%&#@=+<>{}\[\]|~^]") / words, 1e-3, 1.0),
        _log_bin(count("[A-Z]") / chars, 1e-3, 0.5),
        _log_bin(count("[0-9]") / chars, 1e-4, 0.3),
        _log_bin(count("[.,;:?]") / words, 1e-2, 1.0),
        _log_bin((F.octet_length(text) - F.length(text)) / chars, 1e-3, 1.0),
        _log_bin(chars / words, 2.0, 16.0),
        _log_bin(words, 4.0, 8192.0),
        *hits,
    )


HITS = 8  # the lexicon's place among the features


def _domain() -> Column:
    toxic, quality = F.col("toxic").cast("int"), F.col("quality").cast("int")
    return F.when(toxic == 1, 2).when(quality == 1, 0).when(quality == 0, 1)


def _named(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), _domain().alias("k")).where("k is not null and doc_id is not null")


def _lexicon(docs: DataFrame, labels: DataFrame) -> tuple[list[str], float]:
    """Words that name toxic rows, and the share of labelled ids that they were learned from."""
    named = _named(labels)
    part = min(0.5, LEXICON_ROWS / max(1, named.select("doc_id").distinct().count()))
    # drawn by id, as rows of an id must not be on both sides; some LEXICON_ROWS ids, so a broadcast of them is bounded
    drawn = named.where(share(F.col("doc_id"), part)).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(drawn), "doc_id")
    toxic = F.count_if(F.col("k") == 2)
    # a row's words once, and an empty one, which every row is given, for the numbers of rows
    every = F.array_union(F.array(F.lit("")), F.filter(_letters(F.col("text")), lambda w: (F.length(w) > 1) & (F.length(w) <= 32)))
    words = settled(rows.select("k", F.explode(every).alias("word")).groupBy("word").agg(toxic.alias("a"), F.count(F.lit(1)).alias("n")).where(F.col("a") >= LEAST_ROWS))
    whole = words.where("word = ''").first()
    if whole is None:
        return [], part
    odds = F.ln((F.col("a") + 0.5) / (whole["a"] + 1.0)) - F.ln((F.col("n") - F.col("a") + 0.5) / (whole["n"] - whole["a"] + 1.0))
    found = words.where((F.col("word") != "") & (odds >= LEAST_ODDS)).orderBy(F.desc("a"), "word").limit(LEXICON).collect()
    return [r["word"] for r in found], part


def _classifier(known: DataFrame, labels: DataFrame, part: float, n_features: int) -> list:
    """Log weights [feature][bin][domain], and the log prior; known: doc_id, bins; part: the lexicon's share of ids."""
    each = known.join(_named(labels), "doc_id").select("doc_id", "k", F.posexplode("bins").alias("feature", "bin"))
    each = each.where((F.col("feature") != HITS) | ~share(F.col("doc_id"), part))
    count = np.ones((n_features, BINS, len(DOMAINS)))
    for r in each.groupBy("k", "feature", "bin").count().collect():  # at most 9 * 12 * 3 rows
        count[r["feature"], r["bin"], r["k"]] += r["count"]
    total = count.sum(axis=1)
    return [np.log(count / total[:, None, :]).tolist(), np.log(total[0] / total[0].sum()).tolist()]


def _posterior(bins: Column, weights: list) -> Column:
    """Log odds of the domains, up to a constant."""
    table, prior = weights
    flat = F.lit([x for row in table for cell in row for x in cell])
    n = len(DOMAINS)
    cell = lambda f, k: F.get(flat, (f * BINS + F.get(bins, f)) * n + k)
    features_ = F.sequence(F.lit(0), F.lit(len(table) - 1))
    return F.transform(F.lit(prior), lambda x, k: F.aggregate(features_, x, lambda a, f: a + cell(f, k)))


def _steps(logs: Column) -> Column:
    """The posterior in STEPS-ths: the first domains are rounded, the last takes the rest, never below zero."""

    def split(odds: Column) -> Column:
        def shares(whole: Column) -> Column:
            share = lambda k: F.round(F.get(odds, F.lit(k)) / whole * STEPS).cast("int")
            return once(share(0), lambda first: F.struct(first.alias("s0"), F.least(share(1), F.lit(STEPS) - first).alias("s1")))

        return once(F.aggregate(odds, F.lit(0.0), lambda a, x: a + x), shares)

    return once(logs, lambda given: once(F.array_max(given), lambda top: once(F.transform(given, lambda x: F.exp(x - top)), split)))


def _descended(state: Column, goal: list[float], pull: list[float], upper: float | None, close: float, still: float) -> Column:
    """The state after ROUNDS_AT_ONCE rounds, or fewer where it ends; pull: the gradient of a rate by a domain's excess tokens.

    A state has rows (s0, s1, n, p0 to p2, r, before), t of the momentum, totals and those before, rounds, and the end:
    1 where all totals are within `close` of the goal, 2 where the projected gradient moves at most `still` tokens.
    """
    kept = lambda r: F.greatest(F.lit(0.0), r if upper is None else F.least(r, F.lit(float(upper))))
    total = lambda rows, f: F.aggregate(rows, F.lit(0.0), lambda a, x: a + f(x))
    pulled = lambda x, by: x["p0"] * by["g0"] + x["p1"] * by["g1"] + x["p2"] * by["g2"]
    excess = lambda at: [((at(k) - F.lit(goal[k])) * F.lit(pull[k])).alias(f"g{k}") for k in range(3)]

    def step(s: Column) -> Column:
        later = (1 + F.sqrt(1 + 4 * s["t"] * s["t"])) / 2

        def turn(m: Column) -> Column:
            # the gradient is taken at the extrapolated rates: totals of r + momentum * (r - previous)
            return F.struct(m.alias("m"), *excess(lambda k: s[f"now{k}"] + m * (s[f"now{k}"] - s[f"old{k}"])))

        def move(h: Column) -> Column:
            r = lambda x: kept(x["r"] + h["m"] * (x["r"] - x["before"]) - pulled(x, h))
            return F.transform(s["rows"], lambda x: F.struct(*[x[c].alias(c) for c in ("s0", "s1", "n", "p0", "p1", "p2")], r(x).alias("r"), x["r"].alias("before")))

        def close_off(rows: Column) -> Column:
            def end(now: Column) -> Column:
                met = F.greatest(*[F.abs(now[f"now{k}"] - F.lit(goal[k])) for k in range(3)]) <= close
                moved = once(F.struct(*excess(lambda k: now[f"now{k}"])), lambda g: total(rows, lambda x: x["n"] * F.abs(x["r"] - kept(x["r"] - pulled(x, g)))))
                ended = F.when(met, 1).when(moved <= still, 2).otherwise(0)
                return F.struct(rows.alias("rows"), later.alias("t"), *[now[f"now{k}"].alias(f"now{k}") for k in range(3)], *[s[f"now{k}"].alias(f"old{k}") for k in range(3)], (s["rounds"] + 1).alias("rounds"), ended.alias("ended"))

            return once(F.struct(*[total(rows, lambda x, k=k: x["n"] * x["r"] * x[f"p{k}"]).alias(f"now{k}") for k in range(3)]), end)

        return once(once(once((s["t"] - 1) / later, turn), move), close_off)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS_AT_ONCE)), state, lambda s, _: F.when(s["ended"] == 0, step(s)).otherwise(s))


def fit(by_posterior: DataFrame, targets: list[float], upper: float | None, budget: float | None) -> tuple[DataFrame, list[float], list[float]]:
    """(s0, s1, rate) per posterior, the targets in tokens, and the totals reached; by_posterior: s0, s1, n (tokens)."""
    p = _shares()
    sums = [F.sum(F.col("n") * x) for x in p]
    pairs = [F.sum(F.col("n") * p[i] * p[j]) for i in range(3) for j in range(3)]
    row = [float(x or 0) for x in by_posterior.agg(*sums, *pairs).first()]
    have = np.array(row[:3])
    if have.sum() == 0:
        return by_posterior.select("s0", "s1", F.lit(1.0).alias("rate")), [0.0] * 3, [0.0] * 3
    want = np.array(targets) / sum(targets)
    if budget is None:
        budget = have.sum()
    goal = want * budget
    weight = 1 / np.maximum(have, have.sum() * 1e-6)
    size = np.linalg.eigvalsh(np.sqrt(weight)[:, None] * np.array(row[3:]).reshape(3, 3) * np.sqrt(weight)[None, :])[-1]
    # the whole table is one row's array, sorted so that sums have one order
    one = F.struct("s0", "s1", F.col("n").cast("double").alias("n"), *[x.alias(f"p{k}") for k, x in enumerate(p)], F.lit(1.0).alias("r"), F.lit(1.0).alias("before"))
    totals = [F.lit(float(x)).alias(f"{c}{k}") for c in ("now", "old") for k, x in enumerate(have)]
    state = by_posterior.agg(F.sort_array(F.collect_list(one)).alias("rows"))
    state = state.select(F.struct("rows", F.lit(1.0).alias("t"), *totals, F.lit(0).alias("rounds"), F.lit(0).alias("ended")).alias("s"))
    while True:
        state = settled(state.select(_descended(F.col("s"), goal.tolist(), (weight / size).tolist(), upper, TOLERANCE * budget, STILL * budget).alias("s")))
        *reached, rounds, ended = state.select("s.now0", "s.now1", "s.now2", "s.rounds", "s.ended").first()
        if ended or rounds >= ROUNDS:
            break
    if ended != 1:
        why = "no rates come closer" if ended else "the descent was cut off"
        _log.warning("mixing misses its targets after %d rounds (%s): %s of the budget reached, %s wanted", rounds, why, (np.array(reached) / budget).round(4).tolist(), want.round(4).tolist())
    return state.select(F.explode("s.rows").alias("x")).select("x.s0", "x.s1", F.col("x.r").alias("rate")), goal.tolist(), list(reached)


def _shares() -> list[Column]:
    first, second = F.col("s0") / F.lit(float(STEPS)), F.col("s1") / F.lit(float(STEPS))
    return [first, second, F.lit(1.0) - first - second]


def _rated(docs: DataFrame, labels: DataFrame, targets, upper: float | None, by_first: bool) -> tuple[DataFrame, DataFrame, tuple, list]:
    """(doc_id, n_tokens, s0, s1) per row, (s0, s1, rate) per posterior, the classifier with its lexicon, and the totals reached as shares of the budget."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lexicon, part = _lexicon(docs, labels)
    known = settled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), tokens(text).alias("n_tokens"), features(text, lexicon).alias("bins")))
    weights = _classifier(known, labels, part, HITS + bool(lexicon))
    members = known.select("doc_id", "n_tokens", _posterior(F.col("bins"), weights).alias("logs")).select("doc_id", "n_tokens", _steps(F.col("logs")).alias("s")).select("doc_id", "n_tokens", "s.*")
    # at most (STEPS + 1) * (STEPS + 2) / 2 rows
    by_posterior = settled(members.groupBy("s0", "s1").agg(F.sum("n_tokens").cast("double").alias("n")).coalesce(1))
    budget = None
    if by_first:
        budget = float(by_posterior.agg(F.sum(F.col("n") * _shares()[0])).first()[0] or 0) / targets[0] * sum(targets)
    rated, goal, reached = fit(by_posterior, list(targets), upper, budget)
    return members, settled(rated), (weights, lexicon), [x / sum(goal) if sum(goal) else 0.0 for x in reached]


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) by a hash of doc_id."""
    return F.pmod(F.xxhash64(doc_id, F.lit("mixing")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def rates(docs: DataFrame, labels: DataFrame, targets=TARGETS) -> DataFrame:
    """Per document: doc_id, n_tokens, p_clean, p_poor, p_toxic, rate, copies, and reached_clean, reached_poor, reached_toxic:
    the totals that the rates reach, as shares of the budget, the same in all rows.

    The totals aim at the targets' shares of the corpus's own tokens. copies is the rate rounded up or down by a hash of
    doc_id, so that it is the rate on average.
    """
    members, rated, _, reached = _rated(docs, labels, targets, None, False)
    p = _shares()
    # rated has at most some hundred rows whatever the input, so a broadcast of it is bounded
    return members.join(F.broadcast(rated), ["s0", "s1"]).select(
        "doc_id", "n_tokens", *[x.alias(f"p_{d}") for x, d in zip(p, DOMAINS, strict=True)], "rate",
        (F.floor("rate") + (draw(F.col("doc_id")) < F.col("rate") - F.floor("rate")).cast("long")).cast("long").alias("copies"),
        *[F.lit(float(x)).alias(f"reached_{d}") for x, d in zip(reached, DOMAINS, strict=True)],
    )


def mixed(docs: DataFrame, labels: DataFrame, targets=TARGETS) -> DataFrame:
    """The rows of docs that a mix keeps, all columns: rates of at most 1, so that no document is repeated, at the budget
    that needs all of the first domain; a row stays if its draw is below its rate."""
    _, rated, (weights, lexicon), _ = _rated(docs, labels, targets, 1.0, True)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # at most some hundred rates whatever the input, as one array; one expression, so a text's features are made once
    at = lambda s: s["s0"] * (STEPS + 1) + s["s1"]
    found = {at(r): r["rate"] for r in rated.collect()}
    by_place = F.lit([found.get(i, 0.0) for i in range((STEPS + 1) ** 2)])
    rate = once(features(text, lexicon), lambda b: once(_steps(_posterior(b, weights)), lambda s: F.get(by_place, at(s))))
    return docs.where(draw(F.col("doc_id")) < rate)
