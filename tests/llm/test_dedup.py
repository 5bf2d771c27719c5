"""Exact and near duplicates against brute force on small fixtures."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from tideline.llm import exact_dedup, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=""):
    return spark.createDataFrame([(i, t, "en", "s", None, *r) for i, t, *r in rows], DOCS + extra)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: (doc_id, fingerprint) pairs; smallest doc_id reachable for each row."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(prints))]


def near_rows(seed=3, n=120):
    draw = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        base = [words[k] for k in draw.integers(0, 400, 150)]
        rows.append((len(rows), " ".join(base)))
        if i % 4 == 0:
            base[int(draw.integers(0, 150))] = "Changed"
            rows.append((len(rows), " ".join(base)))
    return [*rows, (len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "Two words"), (len(rows) + 3, "two\tWORDS ")]


def test_simhash_matches_definition():
    for _, text in near_rows(n=10):
        assert simhash.simhash(text) == brute_fingerprint(text)
    assert simhash.simhash("É É É É") == brute_fingerprint("É É É É")
    long = "a very long text " * 30_000
    assert simhash.simhash(long) == brute_fingerprint(long)


def test_components_match_brute_force(spark):
    rows = near_rows()
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    prints = [(d, brute_fingerprint(t)) for d, t in rows]
    for (d, fp), want in zip(prints, brute_components(prints), strict=True):
        assert got[d].fingerprint == f"{fp:016x}" and got[d].component_id == want


def test_crowded_tiles_are_cut(spark, monkeypatch):
    """Sub-tiles, chunks and owners of every neighbouring tile give the components of brute force."""
    monkeypatch.setattr(simhash, "SUB_TILE", 3)
    monkeypatch.setattr(simhash, "SUB_TILES_AT_ONCE", 2)
    draw = np.random.default_rng(1)
    prints = []
    for centre in draw.integers(0, 1 << 63, 6).tolist():
        for _ in range(40):
            fp = centre
            for b in draw.integers(0, 64, 3).tolist():
                fp ^= 1 << b
            prints.append(fp)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    from tideline.llm.components import connected_components

    roots = {r.node: r.root for r in connected_components(simhash.links(frame)).collect()}
    want = brute_components(list(zip(signed, prints, strict=True)))
    # component names are least signed fingerprints on both sides
    assert [roots.get(s, s) for s in signed] == want


def test_far_fingerprints_do_not_link(spark):
    prints = [0, 0b1111, 0b1111 << 20, (1 << 40) - 1]
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    assert simhash.links(frame).count() == 0


def test_exact_groups_and_edge_cases(spark):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (4, None), (8, ""), (7, "x"), (7, "x"), (None, "x"), (None, "only"), (1, "A b"), (2, "y" * 300_000), (11, "y" * 300_000)]
    got = exact_dedup.exact_duplicates(documents(spark, [(*r, "k") for r in rows], ", digest string")).collect()
    want = {}
    for d, t in rows:
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
        want.setdefault(key, []).append(d)
    assert len(got) == len(rows)
    for r in got:
        ids = [i for i in want[r.text_sha256] if i is not None]
        assert r.group_size == len(want[r.text_sha256]) and r.keep_id == (min(ids) if ids else None) and r.kept == (r.doc_id == r.keep_id)
    kept = exact_dedup.keep_first(documents(spark, [(*r, "k") for r in rows], ", digest string"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "digest"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "4", "7", "None", "1", "2"])


@pytest.mark.parametrize("n", [1, 2, 5, 300, 5000])
def test_minimal_perfect_hash(n):
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), np.uint8).reshape(-1, 32)
    pilots, slots = exact_dedup.build_mph(digests)
    assert sorted(slots) == list(range(n))
    assert (exact_dedup.find_slots(digests, pilots, n) == slots).all()


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert exact_dedup.exact_duplicates(empty).count() == 0 and exact_dedup.keep_first(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_keep_one_handles_nulls_and_repeats(spark):
    rows = [(3, "one two three four"), (3, "one two three four"), (2, "one two three four"), (2, "one two three four"), (None, "quite another text than that"), (9, None), (10, "")]
    kept = simhash.keep_one(documents(spark, [(*r, 1) for r in rows], ", fp long"))
    assert isinstance(kept.schema, T.StructType) and kept.columns[-1] == "fp"
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "9", "None"]


def test_keep_one_takes_each_components_own_row(spark):
    """Rows without doc_id in different components all stay; of a repeated doc_id the representative's text stays."""
    text = lambda x: " ".join(f"{x}{i}" for i in range(40))
    unnamed = [(None, text(f"n{i}x")) for i in range(4)] + [(None, text("n0x"))]
    # 100 + i has a text of its own and, before or after it, the text of document i
    repeated = [[(100 + i, text(f"own{i}x")), (100 + i, text(f"first{i}x"))][:: 1 if i % 2 else -1] for i in range(6)]
    rows = [*unnamed, *[r for two in repeated for r in two], *[(i, text(f"first{i}x")) for i in range(6)]]
    kept = simhash.keep_one(documents(spark, rows).coalesce(1)).collect()
    want = [(None, text(f"n{i}x")) for i in range(4)] + [(i, text(f"first{i}x")) for i in range(6)] + [(100 + i, text(f"own{i}x")) for i in range(6)]
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(i), t) for i, t in want)


def test_keep_one_keeps_one_row_of_a_component(spark):
    """A doc_id repeated with two texts that are near copies is one component, so one row."""
    words = [f"w{i}" for i in range(300)]
    near = next(t for k in range(300) if 0 < (simhash.simhash(t := " ".join([*words[:k], "Changed", *words[k + 1 :]])) ^ simhash.simhash(" ".join(words))).bit_count() <= 3)
    assert simhash.keep_one(documents(spark, [(3, " ".join(words)), (3, near), (4, " ".join(words))])).count() == 1
