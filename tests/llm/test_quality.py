"""Toxicity, personal data, mixing: definitions, held-out rows and edge cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import mixing, pii, toxicity


def corpus(n=900, seed=2):
    draw = random.Random(seed)
    plain = [f"{a}{b}" for a in ("ra", "to", "mi", "sel", "kun", "po") for b in ("na", "lu", "ter", "sim", "do", "vek", "jas")]
    bad = ["gorbak", "zutfen", "gorbakly", "vilest"]
    rows, marks = [], []
    for i in range(n):
        words = [draw.choice(plain) for _ in range(draw.randint(20, 60))]
        toxic = draw.random() < 0.2
        for _ in range(draw.randint(2, 4) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(bad))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    return rows, marks


def test_toxicity_on_held_out_rows(spark):
    rows, marks = corpus()
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i].predicted == int(got[i].score >= 0.5) for i, _ in rows)
    held = [(got[i].predicted, t) for i, _, t in marks if got[i].held_out]
    assert sum(p == t for p, t in held) >= 0.98 * len(held)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows if got[i].predicted == 0}


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows, marks = corpus(300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in marks]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scores = []
    for given in (marks, flipped):
        model = toxicity.learn(docs, spark.createDataFrame(given, "doc_id long, quality int, toxic int"))
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.score(docs, model).collect()))
    assert scores[0] == scores[1]


def test_toxicity_edges(spark, edge_docs, no_docs, labels):
    for marks in (labels, labels.where("false"), labels.where("toxic = 0")):
        rows = toxicity.score(edge_docs, toxicity.learn(edge_docs, marks)).collect()
        assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(no_docs, toxicity.learn(no_docs, labels)).count() == 0
    kept = toxicity.keep_clean(edge_docs, labels.where("false"))
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


def test_isotonic_fit():
    knots, values = toxicity.isotonic(np.array([3.0, 1, 2, 4, 4]), np.array([0.0, 0, 1, 1, 1]))
    assert list(knots) == [1, 1, 2, 3, 4, 4] and list(values) == [0, 0, 0.5, 0.5, 1, 1]


def test_trees_find_an_interaction():
    draw = np.random.default_rng(1)
    x = draw.random((800, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    margin = toxicity.Trees(x[:600], y[:600]).margin(x[600:])
    assert ((margin > 0) == y[600:]).mean() > 0.95


# --- personal data ---

KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: luhn(v)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 10 <= sum(map(str.isdigit, v)) <= 15),
}


def luhn(value):
    digits = [int(c) for c in value if c.isdigit()][::-1]
    total = sum(d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9) for i, d in enumerate(digits))
    return 14 <= len(digits) <= 19 and total % 10 == 0


def base_spans(text):
    found = [(m.start(), k, n, m.end()) for k, (n, (p, good)) in enumerate(KINDS.items()) for m in re.finditer(p, text or "", re.ASCII) if good(m.group())]
    return ",".join(f"{n}:{a}:{b}" for a, _, n, b in sorted(found))


def scribbles(n=300):
    draw = random.Random(6)
    parts = ["a@b.c", "a@b", "x.y@z.w_v@q.r", "é", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "01.002.3.4", "4041894974608795", "4041 8949-7460 8795", "4041  8949", "+1 (988) 555-2485", "+12", "+1-2.3(4)5 6789012", "++44 20 7946 0958x", " ", "\n", ".", "-", "12345678901234567890123", "@", "+", "😀", "a%b+c@d-e.f-g.h"]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(n)]


def test_base_spans(spark):
    texts = [*scribbles(), "a" * 30_000, "9." * 9_000, "a@b.c " * 3_000, "a." * 4_000 + "a@b" + ".c" * 9_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t[:200], want[:200], got[i].spans[:200])
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(want.count(f"{k}:") for k in KINDS)
        assert set(filter(None, want.split(","))) <= set(got[i].spans.split(","))


def test_patterns_find_unseen_identifiers(spark):
    """A label before known phones marks an unknown form after the same label; common words mark nothing."""
    draw = random.Random(3)
    number = lambda: f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}"
    texts = [f"note {i} tel: {number()} and the end" for i in range(30)] + [f"the {number()} here" for i in range(30)]
    texts += ["tel: 555-0142-77 please", "the 555-0199-88 please"] + ["the end of the day"] * 200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert got[60].spans == "phone:5:16" and got[60].n_phone == 0 and got[60].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[61].spans == "" and all(got[i].spans == base_spans(texts[i]) for i in range(60))


def test_personal_data_edges(spark, edge_docs, no_docs):
    rows = pii.find(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        if r.doc_id == 11:
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 0, 1)
    assert pii.find(no_docs).count() == 0


# --- mixing ---


def brute_rates(p, n, targets, upper=None, rounds=4000):
    """Projected gradient in the tokens' metric, one rate per document."""
    r, goal = np.ones(len(n)), np.array(targets) / sum(targets) * n.sum()
    have = (n[:, None] * p).sum(axis=0)
    weight = 1 / have
    size = np.linalg.eigvalsh(np.sqrt(weight)[:, None] * (p.T * n) @ p * np.sqrt(weight)[None, :])[-1]
    for _ in range(rounds):
        r = np.clip(r - p @ (weight * ((r * n) @ p - goal)) / size, 0, upper)
    return (r * n) @ p, goal


def test_rates_reach_the_targets(spark):
    rows, marks = corpus(600, 8)
    shouting = lambda t: " ".join(w.upper() + "!!!" if k % 2 else w + "***" for k, w in enumerate(t.split()))
    marks = [(i, int(i % 4 != 0), t) for i, _, t in marks]
    rows = [(i, shouting(t) if i % 4 == 0 else t) for i, t in rows]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    targets = (0.55, 0.35, 0.10)
    got = mixing.rates(docs, labels, targets).toPandas().set_index("doc_id").sort_index()
    p, n = got[["p_clean", "p_poor", "p_toxic"]].to_numpy(), got["n_tokens"].to_numpy(float)
    assert np.allclose(p.sum(axis=1), 1) and (got["rate"] >= 0).all() and (abs(got["copies"] - got["rate"]) < 1).all()
    assert list(got["n_tokens"]) == [len(t.split()) for _, t in rows]
    reached, goal = brute_rates(p, n, targets)
    mine = (got["rate"].to_numpy() * n) @ p
    assert np.abs(mine - goal).max() <= np.abs(reached - goal).max() + 0.01 * n.sum()
    assert got[["p_poor"]].to_numpy()[::4].mean() > 0.5 > got[["p_poor"]].to_numpy()[1::4].mean()


def test_the_lexicon_tells_toxic_rows(spark):
    """The lexicon is the one that plain counting gives; unseen toxic rows with its words get a high share of that domain."""
    draw = random.Random(21)
    plain, bad = [f"p{chr(97 + i)}{c}" for i in range(20) for c in "xyz"], ["Vorg", "GLAB", "nüsk", "Trod"]
    text = lambda toxic: " ".join([draw.choice(plain) for _ in range(30)] + ([draw.choice(bad) + "," for _ in range(3)] if toxic else []))
    marks = [(i, int(i % 2), int(i % 5 == 0)) for i in range(800)]
    rows = [(i, text(t)) for i, _, t in marks] + [(900, text(1)), (901, text(0)), (902, None)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*marks, (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found, part = mixing._lexicon(docs, labels)
    drawn = {r.doc_id for r in labels.dropna().where(mixing.share(F.col("doc_id"), part)).collect()}
    assert part == 0.5 and 300 < len(drawn) < 500
    toxic, of = {i for i, _, t in marks if t} & drawn, {i: set(re.findall(r"[^\W\d_]+", t.lower())) for i, t in rows if t}
    odds = lambda w: (a := sum(w in of[i] for i in toxic), math.log((a + 0.5) / (len(toxic) + 1)) - math.log((sum(w in of[i] for i in drawn - toxic) + 0.5) / (len(drawn - toxic) + 1)))
    every = {w: odds(w) for w in set().union(*of.values())}
    want = sorted((w for w, (a, o) in every.items() if a >= 3 and o >= 3), key=lambda w: (-every[w][0], w))
    assert found == want and set(found) == {w.lower() for w in bad}
    got = {r.doc_id: r for r in mixing.rates(docs, labels).collect()}
    assert all((got[i].p_toxic > 0.5) == bool(t) for i, _, t in marks) and got[900].p_toxic > 0.5 > 0.1 > max(got[901].p_toxic, got[902].p_toxic)
    assert abs(got[0].reached_toxic - 0.06) < 0.002
    assert mixing._lexicon(docs, labels.where("toxic = 0"))[0] == [] and mixing._lexicon(docs.where("false"), labels)[0] == []


def test_bounded_rates_match_brute_force(spark):
    draw = np.random.default_rng(4)
    steps = [(int(a), int(b)) for a, b in draw.integers(0, 17, (80, 2))]
    frame = spark.createDataFrame([(a, b, float(draw.integers(1, 100))) for a, b in steps], "s0 int, s1 int, n double").groupBy("s0", "s1").agg(F.sum("n").alias("n")).coalesce(1).cache()
    p = np.array([(r.s0 / 32, r.s1 / 32, 1 - (r.s0 + r.s1) / 32) for r in frame.collect()])
    n = np.array([r.n for r in frame.collect()])
    for upper in (None, 1.0):
        _, goal, reached = mixing.fit(frame, [0.3, 0.3, 0.4], upper, None)
        brute, same = brute_rates(p, n, [0.3, 0.3, 0.4], upper)
        # by the objective, as totals beyond reach can be missed in more than one way
        loss = lambda t: float((((t - same) ** 2) / (n[:, None] * p).sum(axis=0)).sum())
        assert np.allclose(goal, same) and loss(np.array(reached)) <= 1.05 * loss(brute) + 1e-5 * n.sum()


def slow_table(spark):
    """Toxic tokens hide in small differences of posteriors, so each round moves the totals by little."""
    rows = [(31 - i % 2 - j, j, 1000.0 / (1 + i)) for i in range(3) for j in (0, 1, 2, 3, 24, 28)]
    return spark.createDataFrame(rows, "s0 int, s1 int, n double").groupBy("s0", "s1").agg(F.sum("n").alias("n")).coalesce(1)


def test_the_descent_goes_on_while_targets_can_be_met(spark):
    for targets in ([0.50, 0.45, 0.05], [0.57, 0.39, 0.04]):
        rated, goal, reached = mixing.fit(slow_table(spark), targets, None, None)
        assert np.abs(np.array(reached) - goal).max() <= mixing.TOLERANCE * sum(goal)
        # the rates make these totals
        rows = rated.join(slow_table(spark), ["s0", "s1"]).collect()
        p = np.array([(r.s0 / 32, r.s1 / 32, 1 - (r.s0 + r.s1) / 32) for r in rows])
        assert np.allclose([r.rate * r.n for r in rows] @ p, reached)


def test_targets_out_of_reach_are_logged(spark, caplog):
    frame = slow_table(spark)
    mixing.fit(frame, [0.57, 0.39, 0.04], None, None)
    assert not caplog.records
    _, goal, reached = mixing.fit(frame, [0.1, 0.1, 0.8], 1.0, None)
    assert reached[2] < 0.5 * goal[2] and "misses its targets" in caplog.text and "no rates come closer" in caplog.text


def test_mixing_edges(spark, edge_docs, no_docs, labels):
    for marks in (labels, labels.where("false")):
        rows = mixing.rates(edge_docs, marks).collect()
        assert len(rows) == edge_docs.count() and all(r.rate >= 0 for r in rows)
        kept = mixing.mixed(edge_docs, marks)
        assert kept.columns == edge_docs.columns and kept.count() <= edge_docs.count()
    assert mixing.rates(no_docs, labels).count() == 0 and mixing.mixed(no_docs, labels).count() == 0


@pytest.mark.parametrize("domain", [0, 1])
def test_posterior_in_steps(spark, domain):
    logs = F.array(*[F.lit(0.0 if k != domain else 50.0) for k in range(3)])
    s = spark.range(1).select(mixing._steps(logs).alias("s")).first()["s"]
    assert (s["s0"], s["s1"]) == ((32, 0) if domain == 0 else (0, 32))


def test_masked_addresses_of_any_length(spark):
    """A label before addresses marks a masked one whole, whatever its length."""
    label = [f"write mail: jo{i}@mail.example.com today" for i in range(30)]
    names = ["n" * n for n in (40, 100, 10_000)]
    texts = [*label, *[f"mail: {n}(at)example now" for n in names], "q" * 60_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert [got[30 + i].spans for i in range(3)] == [f"email:6:{6 + len(n) + len('(at)example')}" for n in names] and got[33].spans == ""


def test_found_values_induce_patterns(spark):
    """A label before known phones finds local numbers; these show a second label, which finds numbers that no first label has."""
    draw = random.Random(8)
    local = lambda: f"555-{draw.randint(1000, 9999)}-{draw.randint(10, 99)}"
    noise = lambda: " ".join(draw.choice(["the", "a", "of", "and", "to"]) for _ in range(6))
    # an unseen number after a label counts against it until the label holds, so it needs enough shared ones
    shared, unseen = [local() for _ in range(12)], [local() for _ in range(2)]
    texts = [f"{noise()} tel: +1 (212) 555-{1000 + i} {noise()}" for i in range(60)]
    texts += [f"{noise()} tel: {x} {noise()}" for x in shared] + [f"{noise()} ring: {x} {noise()}" for x in shared]
    first = len(texts)
    texts += [f"{noise()} ring: {x} {noise()}" for x in unseen]
    # plain numbers after common words, and after a label of something else, are no personal data
    plain = len(texts)
    texts += [f"{noise()} {local()} {noise()}" for _ in range(20)] + [f"{noise()} part: {local()} {noise()}" for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    span = lambda i, label: f"phone:{texts[i].index(label) + len(label)}:{texts[i].index(label) + len(label) + 11}"
    caught = [i for i in range(first, plain) if got[i] == span(i, "ring: ")]
    wrong = [i for i in range(plain, len(texts)) if got[i]]
    assert len(caught) == plain - first and not wrong
    assert all(got[60 + i] == span(60 + i, "tel: ") for i in range(12))


def test_right_contexts(spark):
    texts = [f"w{i} 10.0.{i}.7 (host) w{i}" for i in range(30)] + ["see w 555 0142 77 (host)"] + ["see w 555 0142 78 (else)"]
    docs = spark.createDataFrame([(i, t.replace("10.0", "10.1")) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert got[30] == "ip:6:17" and got[31] == ""


def test_repeated_ids_do_not_swell_the_sample(spark, monkeypatch):
    """Labelled rows that repeat one doc_id with many texts are drawn one by one, so learning stays bounded."""
    rows, marks = corpus(400)
    hot = next(i for i, _ in rows if zlib.crc32(str(i).encode()) % 5)
    docs = spark.createDataFrame([(hot, f"{t} w{i}") for i, t in rows * 3], "doc_id long, text string")
    seen = []
    made = toxicity.Model
    monkeypatch.setattr(toxicity, "Model", lambda w, x, y: seen.append(len(y)) or made(w, x, y))
    toxicity.learn(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), 100)
    assert 0 < seen[0] < 200 if seen[0] else True


def brute_margin(x_fit, y, x):
    """Boosted trees by exhaustive search over the same thresholds, row by row."""
    edges = [np.unique(np.quantile(x_fit[:, j], np.linspace(0, 1, toxicity.BINS + 1)[1:-1])) for j in range(x_fit.shape[1])]
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = np.log(share / (1 - share))
    fit, out = np.full(len(y), base), np.full(len(x), base)
    for _ in range(toxicity.TREES):
        p = 1 / (1 + np.exp(-fit))
        g, h = p - y, p * (1 - p)

        def grow(rows, depth):
            if depth == toxicity.DEPTH:
                return -toxicity.RATE * g[rows].sum() / (h[rows].sum() + toxicity.RIDGE)
            best = (1e-9, None, None)
            for j, cuts in enumerate(edges):
                for cut in cuts:
                    left = x_fit[rows, j] < cut
                    a, b = rows[left], rows[~left]
                    if h[a].sum() < toxicity.LEAST_HESSIAN or h[b].sum() < toxicity.LEAST_HESSIAN:
                        continue
                    score = lambda r: g[r].sum() ** 2 / (h[r].sum() + toxicity.RIDGE)
                    gain = score(a) + score(b) - score(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, j, cut)
            if best[1] is None:
                return grow(rows, depth + 1)
            left = x_fit[rows, best[1]] < best[2]
            return best[1], best[2], grow(rows[left], depth + 1), grow(rows[~left], depth + 1)

        tree = grow(np.arange(len(y)), 0)

        def leaf(node, row):
            while isinstance(node, tuple):
                node = node[2] if row[node[0]] < node[1] else node[3]
            return node

        fit += [leaf(tree, r) for r in x_fit]
        out += [leaf(tree, r) for r in x]
    return out


def test_trees_match_exhaustive_search(monkeypatch):
    monkeypatch.setattr(toxicity, "TREES", 6)
    draw = np.random.default_rng(3)
    x = np.round(draw.random((150, 4)), 2)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + draw.normal(0, 0.2, 150)) > 0.8).astype(float)
    assert np.allclose(toxicity.Trees(x[:100], y[:100]).margin(x), brute_margin(x[:100], y[:100], x), atol=1e-6)


def test_scores_of_the_query_match_the_model_by_hand(spark):
    """op3's scores over whole texts: features counted in plain Python, trees and knots walked one by one."""
    rows, marks = corpus(300, 5)
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    weight = lambda w: max([model.lexicon.words.get(w, 0.0), *[model.lexicon.stems.get(w[:n], 0.0) for n in toxicity.STEMS if len(w) >= n]])
    for i, t in rows[:60]:
        words = re.findall(r"[^\W\d_]+", t.lower())
        hits = [weight(w) for w in words if weight(w)]
        different = {w: weight(w) for w in words if weight(w)}
        n = max(1, len(words))
        x = [sum(hits) / n, np.log1p(sum(hits)), len(hits) / n, np.log1p(len(hits)), sum(different.values()), max(different.values(), default=0.0), *[0.0] * 7]
        margin = model.trees.base
        for splits, leaves in model.trees.trees:
            node = 0
            for level in splits:
                j, b = level[node]
                node = 2 * node + int(np.searchsorted(model.trees.edges[j], x[j], side="right") > b)
            margin += leaves[node]
        assert got[i] == pytest.approx(float(np.interp(margin, model.knots, model.values)), abs=1e-9)
