"""Fingerprints against sets of paragraphs; URL filters against brute force; the pipeline as a whole."""

import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tideline.llm import fingerprint, url_filter


def paragraphs(text):
    return set((text or "").split("\n"))


def likeness(a, b):
    return len(paragraphs(a) & paragraphs(b)) / len(paragraphs(a) | paragraphs(b))


def check_fingerprints(spark, rows):
    got = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    rows = sorted(rows)
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert r.next_id == rows[(k + 1) % len(rows)][0] and r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(text, edited)) and r.near_next == pytest.approx(likeness(text, after))
    by_text = {}
    for i, text in rows:
        assert by_text.setdefault(text or "", got[i].fingerprint) == got[i].fingerprint
    assert len(set(by_text.values())) == len({frozenset(paragraphs(t)) for t in by_text})
    return got


def test_fingerprints(spark):
    draw = random.Random(5)
    line = lambda: " ".join(draw.choice(["aa", "bé", "c😀c", "d"]) for _ in range(draw.randint(0, 5)))
    rows = [(i * 3, "\n".join(line() for _ in range(draw.choice([1, 2, 5, 12, 40, 90])))) for i in range(60)]
    check_fingerprints(spark, [*rows, (1000, ""), (1001, None), (1002, "x"), (1003, rows[5][1]), (1004, "long " * 30_000)])


def test_stuck_peeling_is_retried(spark, monkeypatch):
    """With far too few blocks the first tries fail, and larger ones, or the digests themselves, give the same result."""
    monkeypatch.setattr(fingerprint, "PER_BLOCK", 60)
    draw = random.Random(7)
    rows = [(i, "\n".join(str(draw.randint(0, 400)) for _ in range(100))) for i in range(12)]
    check_fingerprints(spark, rows)
    monkeypatch.setattr(fingerprint, "RETRIES", 0)
    check_fingerprints(spark, rows)


def test_single_document_and_edges(spark, edge_docs, no_docs):
    got = check_fingerprints(spark, [(5, "a\nb\nc")])
    assert got[5].next_id == 5 and got[5].near_next == 1.0
    rows = fingerprint.fingerprints(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {r.next_id for r in rows if r.doc_id is None} == {1} and {r.next_id for r in rows if r.doc_id == 11} == {1}
    unnamed = fingerprint.fingerprints(edge_docs.where("doc_id is null")).collect()
    assert len(unnamed) == 2 and all(r.next_id is None for r in unnamed)
    assert fingerprint.fingerprints(no_docs).count() == 0


def test_sketch_subtracts_and_peels(spark):
    keys = lambda *v: F.array(*[F.lit(x).cast("long") for x in v])
    one = lambda c: spark.range(1).select(c.alias("r")).first()["r"]
    assert one(fingerprint.differing(keys(1, 2, 3), keys(2, 3, 4, 5), F.lit(0))) == 3
    assert one(fingerprint.differing(keys(1, 2, 3), keys(3, 2, 1), F.lit(2))) == 0
    assert one(fingerprint.differing(keys(*range(400)), keys(*range(900, 1300)), F.lit(0))) is None
    assert one(fingerprint.differing(keys(*range(100)), keys(*range(50, 150)), F.lit(5))) == 100


# --- URL filters ---


def brute_active(entries, day):
    state = {}
    for _, list_, domain, _, action in sorted((d, l, n, a == "remove", a) for l, n, a, d in entries if d <= day):
        state[list_, domain] = action
    return {k for k, v in state.items() if v == "add"}


def test_url_filter_matches_brute_force(spark, monkeypatch):
    draw = random.Random(9)
    day = lambda: datetime.date(2024, 1, 1) + datetime.timedelta(days=draw.randint(0, 30))
    hosts = ["a.b.example.com", "example.com", "b.example.com", "xample.com", "other.org", "deep.other.org"]
    entries = [(draw.choice(["x", "y"]), draw.choice([*hosts, "com", "org"]), draw.choice(["add", "remove"]), day()) for _ in range(60)]
    entries += entries[:5]
    captures = [(i, f"{draw.choice(['http', 'HTTPS'])}://{draw.choice(['', 'u:p@'])}{draw.choice(hosts).upper()}{draw.choice(['', ':80', '.'])}/p?q#f", day()) for i in range(200)]
    frame = spark.createDataFrame(captures, "page_id long, url string, day date")
    listed = spark.createDataFrame(entries, "list string, domain string, action string, day date")
    for rows in (200_000, 0):
        monkeypatch.setattr(url_filter, "BROADCAST_ROWS", rows)
        got = {r.page_id: r for r in url_filter.evaluate(frame, listed).collect()}
        for i, url, when in captures:
            name = url.split("/")[2].rpartition("@")[2].split(":")[0].rstrip(".").lower()
            met = sorted((-len(d), d, l) for l, d in brute_active(entries, when) if name == d or name.endswith("." + d))
            assert got[i].host == name and got[i].n_entries == len(met) and got[i].blocked == bool(met)
            assert (got[i].entry, got[i].list) == ((met[0][1], met[0][2]) if met else (None, None))


def test_url_edges(spark):
    captures = spark.createDataFrame([(1, None, None, "x"), (1, "http://a.b/", None, "x"), (2, "nonsense", datetime.date(2024, 1, 2), "x"), (3, "http:///", datetime.date(2024, 1, 2), "x"), (None, "http://a.b/", datetime.date(2024, 1, 2), "x"), (4, "http://" + "a." * 200 + "b/", datetime.date(2024, 1, 2), "x")], "page_id long, url string, day date, list string")
    entries = spark.createDataFrame([("l", ".A.b.", "add", datetime.date(2024, 1, 1)), (None, "a.b", "add", datetime.date(2024, 1, 1)), ("l", None, "add", None)], "list string, domain string, action string, day date")
    got = url_filter.evaluate(captures, entries).collect()
    assert len(got) == 6 and sorted(str(r.page_id) for r in got if r.blocked) == ["4", "None"]
    assert url_filter.evaluate(captures.where("false"), entries).count() == 0
    assert all(not r.blocked for r in url_filter.evaluate(captures, entries.where("false")).collect())


# --- the pipeline ---


def test_pipeline_on_edge_cases(spark, edge_docs, no_docs, labels, tmp_path):
    for name, docs in (("edge", edge_docs), ("none", no_docs)):
        folder = str(tmp_path / name)
        docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")
        labels.coalesce(1).write.parquet(f"{folder}/labels.parquet")
        out = corpus_pipeline.run(spark, folder)
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() <= docs.count()


def test_pipeline_against_brute_force(spark, tmp_path):
    """What each stage removes, by plain Python over the same rows."""
    from tideline.llm import mixing, simhash, toxicity

    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(draw.choice(vocabulary) for _ in range(80)), "en", "s", 1) for i in range(150)]
    rows += [(1000 + i, rows[i][1].replace(" ", "  "), "en", "s", 1) for i in range(20)]
    rows += [(2000 + i, rows[i][1] + " tail", "en", "s", 1) for i in range(20, 40)]
    rows = [(i, t + " gorbak gorbak zutfen", *r) if i % 7 == 0 and i < 150 else (i, t, *r) for i, t, *r in rows]
    marks = [(i, 1, int(i % 7 == 0)) for i in range(150)]
    folder = str(tmp_path / "d")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    left = {r[0]: r[1] for r in rows}
    given = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, given, folder)
        assert out.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        given = spark.read.parquet(path)
        kept = {r.doc_id for r in given.collect()}
        assert given.count() == len(kept)
        if name == "toxicity":
            want = {i for i in left if "gorbak" not in left[i]}
        elif name == "exact_dedup":
            first = {}
            for i in sorted(left):
                first.setdefault(" ".join(left[i].split()), i)
            want = set(first.values())
        elif name == "simhash_near_dedup":
            ids = sorted(left)
            prints = {i: simhash.simhash(left[i]) for i in ids}
            root = {i: i for i in ids}
            find = lambda i: i if root[i] == i else find(root[i])
            for a in ids:
                for b in ids:
                    if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                        x, y = sorted((find(a), find(b)))
                        root[y] = x
            want = {i for i in ids if root[i] == i}
        else:
            want = kept
            assert kept <= set(left) and len(kept) > 0.8 * len(left)
        assert kept == want, name
        left = {i: left[i] for i in kept}
    assert mixing.TARGETS[0] > 0.5 and toxicity.SAMPLE_ROWS > 0
    encoded = corpus_pipeline.STAGES[4][1](spark, given, folder).collect()
    assert {r.doc_id: r.decoded_sha256 for r in encoded} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in left.items()}


def test_mixing_stage_against_brute_force(spark, tmp_path):
    """The kept rows follow from posteriors, rates and draws in plain numpy, one rate per document."""
    import re

    import numpy as np
    import xxhash

    from tideline.llm import mixing

    draw = random.Random(12)
    bare = lambda: " ".join(f"w{draw.randint(0, 200)}" for _ in range(draw.randint(10, 90)))
    loud = lambda t: " ".join(w.upper() + "!" * draw.randint(0, 2) for w in t.split())
    rows = [(i, loud(bare()) if i % 3 == 0 else bare(), "en", "s", 1) for i in range(300)]
    marks = [(i, int(i % 3 != 0), int(i % 9 == 0)) for i in range(0, 300, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.mixing_stage(spark, docs, str(tmp_path)).collect()}

    def bin_(v, least, most):
        return 0 if v <= 0 else int(min(11, max(1, np.floor((np.log(max(v, 1e-9)) - np.log(least)) / ((np.log(most) - np.log(least)) / 10)) + 2)))

    def bins(t):
        chars, words, count = len(t), len(t.split()), lambda p: len(re.findall(p, t))
        return [
            bin_(t.count("!") / words, 1e-3, 1.0), bin_(count(r"[*$%&#@=+<>{}\[\]|~^]") / words, 1e-3, 1.0), bin_(count("[A-Z]") / chars, 1e-3, 0.5), bin_(count("[0-9]") / chars, 1e-4, 0.3),
            bin_(count("[.,;:?]") / words, 1e-2, 1.0), 0, bin_(chars / words, 2.0, 16.0), bin_(words, 4.0, 8192.0),
        ]

    of = {i: bins(t) for i, t, *_ in rows}
    count = np.ones((8, 12, 3))
    for i, quality, toxic in marks:
        for f, b in enumerate(of[i]):
            count[f, b, 2 if toxic else 0 if quality else 1] += 1
    total = count.sum(axis=1)
    logs = np.array([np.log(total[0] / total[0].sum()) + sum(np.log(count[f, b] / total[f]) for f, b in enumerate(of[i])) for i, *_ in rows])
    odds = np.exp(logs - logs.max(axis=1, keepdims=True))
    share = np.floor(odds / odds.sum(axis=1, keepdims=True) * 32 + 0.5)
    s0, s1 = share[:, 0], np.minimum(share[:, 1], 32 - share[:, 0])
    p, n = np.stack([s0, s1, 32 - s0 - s1], axis=1) / 32, np.array([float(len(t.split())) for _, t, *_ in rows])
    have, want = n @ p, np.array(mixing.TARGETS)
    goal = want / want[0] * have[0]
    weight = 1 / np.maximum(have, have.sum() * 1e-6)
    size = np.linalg.eigvalsh(np.sqrt(weight)[:, None] * ((p.T * n) @ p) * np.sqrt(weight)[None, :])[-1]
    pull, clip = (lambda r: p @ (weight * ((n * r) @ p - goal) / size)), (lambda r: np.clip(r, 0, 1))
    rate = before = np.ones(len(n))
    t = 1.0
    while np.abs((n * rate) @ p - goal).max() > 1e-3 * goal.sum() and n @ np.abs(rate - clip(rate - pull(rate))) > 1e-7 * goal.sum() or t == 1.0:
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at = rate + (t - 1) / later * (rate - before)
        rate, before, t = clip(at - pull(at)), rate, later
    number = lambda i: xxhash.xxh64_intdigest(b"mixing", xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42)) % (1 << 30) / (1 << 30)
    assert kept == {i for (i, *_), r in zip(rows, rate, strict=True) if number(i) < r} and 10 < len(kept) < 290
