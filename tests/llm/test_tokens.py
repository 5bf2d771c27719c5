"""Encoding and token counts against the libraries; language identification against the definition."""

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tideline.llm import bpe, language_id, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strange(n, seed=4):
    draw = random.Random(seed)
    signs = list("abcdefXYZ '\t\n\r\x0b\x0c\x1c\x1f\x85   　​éñß中文한न́²½Ⅷ٣😀.,!?-_019") + ["<|endoftext|>", "'s", "'re", "  ", " the", "ing", "tion"]
    return ["".join(draw.choice(signs) for _ in range(draw.randint(0, 40))) for _ in range(n)]


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_encoding_as_the_library(spark):
    _, encoding = library()
    texts = [*strange(400), "a" * 5_000, " " * 3_000 + "x", "ab" * 700 + " tail", "<|endoftext|>"]
    got = {r.doc_id: r for r in bpe.round_trip(docs_of(spark, texts), RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = encoding.encode_ordinary(t)
        assert got[i].n_tokens == len(ids), t
        assert got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_fold_and_heap_agree(spark):
    """Every pre-token by the fold, by the heap and by the library."""
    ranks, encoding = library()
    codec = bpe.Codec(spark, ranks, public_tokenizers.PATTERN)
    words = sorted({w for t in strange(200, 9) for w in regex.findall(public_tokenizers.PATTERN, t)} | {"a" * 3_000, " abab" * 1, "ab" * 400})

    ids = spark.createDataFrame([(w,) for w in words], "w string").select("w", codec.fold(F.col("w")).alias("ids"))
    rows = ids.select("w", "ids", codec.unpacked(codec.packed(F.col("ids"))).alias("again"), codec.decoded(F.col("ids")).alias("decoded")).collect()
    for r in rows:
        want = encoding.encode_ordinary(r.w)
        assert r.ids == want == bpe.merge_all(r.w.encode(), ranks) == r.again and bytes(r.decoded) == r.w.encode(), r.w
    wrong = spark.range(1).select(codec.decoded(F.array(F.lit(1), F.lit(10**6))).alias("d")).first()
    assert wrong["d"] is None


def test_small_dictionary_gives_the_same(spark, monkeypatch):
    """With few words known, and with none, the ids are those of the library."""
    _, encoding = library()
    texts = strange(100, 3) * 3
    for most in (8, 1):
        monkeypatch.setattr(bpe, "WORDS", most)
        got = {r.doc_id: r for r in bpe.round_trip(docs_of(spark, texts), RANKS, public_tokenizers.PATTERN).collect()}
        assert [got[i].n_tokens for i in range(len(texts))] == [len(encoding.encode_ordinary(t)) for t in texts]


def test_splitting_by_code_point(spark):
    """Code points of all planes, later letters and numbers among them, split as in the library's pattern."""
    points = [*range(1, 0x3400, 3), *range(0x3400, 0x110000, 997), 0x870, 0x8C9, 0xA7DC, 0x16130, 0x1E5FA, 0x1E5F0, 0x2EBF0, 0x323AF, 0x323B0, 0x13460]
    texts = ["a" + chr(c) + "1" + chr(c) + " " + chr(c) + "!" + chr(c) + "\n" for c in points if not 0xD800 <= c < 0xE000]
    ranks = {bytes([i]): i for i in range(256)}
    for t in texts:
        for piece in (t[:2], t[2:4], t[4:6], t[6:8], t[5], t[4:7], t[5:8], t[4:8], t[2:], t[4:]):
            ranks.setdefault(piece.encode(), len(ranks))
    split = tiktoken.Encoding("split", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = docs_of(spark, texts).select("doc_id", F.regexp_extract_all("text", F.lit(bpe.jvm_pattern(public_tokenizers.PATTERN)), F.lit(0)).alias("w")).collect()
    for r in rows:
        if all(w.encode() in ranks for w in r.w):
            assert split.encode_ordinary(texts[r.doc_id]) == [ranks[w.encode()] for w in r.w], hex(points[r.doc_id])


def test_encoding_edges(spark, edge_docs, no_docs):
    _, encoding = library()
    got = bpe.round_trip(edge_docs, RANKS, public_tokenizers.PATTERN).collect()
    want = sorted(len(encoding.encode_ordinary(r.text or "")) for r in edge_docs.collect())
    assert sorted(r.n_tokens for r in got) == want
    assert bpe.round_trip(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_counts_as_the_library(spark, edge_docs, no_docs, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_counts, "CACHE", 64)  # started anew many times
    texts = [*strange(400, 7), "a" * 20_000, "<|endoftext|> <|endoftext|>x<|endoftext"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        if name.endswith("json"):
            tokenizer = Tokenizer.from_file(path)
            count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
        else:
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            count = lambda t: len(processor.encode(t))
        got = {r.doc_id: r for r in token_counts.token_counts(docs_of(spark, texts), path, 5).collect()}
        for i, t in enumerate(texts):
            assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (count(t), len(t.encode()), count(t) > 5), (name, t)
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = token_counts.token_counts(edge_docs, path).collect()
    assert len(rows) == edge_docs.count() and sum(r.n_bytes == 0 for r in rows) == 3
    assert token_counts.token_counts(no_docs, path).count() == 0


def brute_bits(texts, text, order=language_id.ORDER):
    """Code length in bits of a text by one language's texts, symbol by symbol."""
    data = "\n".join(texts).encode().lower()
    data = b" " * order + data
    seen: dict = {}
    for k in range(order + 1):
        for i in range(order, len(data)):
            at = seen.setdefault(data[i - k : i], {})
            at[data[i]] = at.get(data[i], 0) + 1
    total, padded = 0.0, b" " * order + text.encode().lower()
    for i in range(order, len(padded)):
        for k in range(order, -1, -1):
            at = seen.get(padded[i - k : i])
            if at is None:
                continue
            n, kinds = sum(at.values()), len(at)
            if padded[i] in at:
                total += np.log2((n + kinds) / at[padded[i]])
                break
            total += np.log2((n + kinds) / kinds)
        else:
            total += 8
    return total


def test_code_lengths_match_the_definition(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(language_id, "LEAST", 1)
    texts = {"aa": ["the cat sat on the mat", "a cat"], "bb": ["der hund und die katze", "ein hund"]}
    rows = []
    for lang, given in texts.items():
        for k, (codes, counts) in enumerate(language_id.gram_counts("\n".join(given))):
            rows += [(lang, k, int(c), int(n)) for c, n in zip(codes, counts, strict=True)]
    model = language_id.Model(pd.DataFrame(rows, columns=["lang", "k", "code", "n"]))
    for text in ("the hund sat", "katze", "zzz ÿ", "A CAT"):
        want = [brute_bits(texts[x], text) for x in ("aa", "bb")]
        assert np.allclose(model.bits(text), want, rtol=1e-5)
    whole = model.bits("the cat sat on a mat")
    monkeypatch.setattr(language_id, "AT_ONCE", 5)
    assert np.allclose(model.bits("the cat sat on a mat"), whole)
    assert model.predict("the cat")[0] == "aa" and model.predict("12 34") == ("und", 0.0) and model.predict(None) == ("und", 0.0)


def test_language_of_held_out_rows(spark, edge_docs, no_docs):
    words = {"en": "the of and house water with from this".split(), "fr": "le des maison eau avec pour cette été".split(), "es": "el los casa agua con para esta año".split()}
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choice(words[x]) for _ in range(30)), x) for i, x in enumerate(draw.choice(list(words)) for _ in range(600))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(docs, language_id.learn(docs)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    held = [i for i, _, _ in rows if got[i].held_out]
    assert held and all(got[i].lang_pred == rows[i][2] and 0.5 < got[i].score <= 1 for i in held)
    rows = language_id.identify(edge_docs, language_id.learn(edge_docs)).collect()
    assert len(rows) == edge_docs.count() and {r.lang_pred for r in rows if r.doc_id in (2, 3)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows)
    empty = language_id.learn(no_docs)
    assert language_id.identify(no_docs, empty).count() == 0
    assert {r.lang_pred for r in language_id.identify(edge_docs, empty).collect()} == {"und"}


@pytest.mark.parametrize("word", [b"", b"a", b"aaaa", "中文中文".encode()])
def test_heap_on_small_words(word):
    ranks, encoding = library()
    want = encoding.encode_ordinary(word.decode()) if word else []
    assert (bpe.merge_all(word, ranks) if word else []) == want


def test_workers_split_by_code_point():
    """Letters and numbers that the workers' matcher knows and the library doesn't, and others of all planes."""
    as_points = lambda ranges: [int(end, 16) for r in ranges.split() for end in r.split("-")]
    points = [*range(1, 0x3400, 7), *range(0x3400, 0x110000, 1999), *as_points(bpe.NEWER_LETTERS), *as_points(bpe.NEWER_NUMBERS)]
    split = bpe.splitter(public_tokenizers.PATTERN)
    ranks = {bytes([i]): i for i in range(256)}
    texts = ["a" + chr(c) + "1" + chr(c) + " " + chr(c) + "!" + chr(c) + "\n" for c in points if not 0xD800 <= c < 0xE000]
    for t in texts:
        for a in range(len(t)):
            for b in range(a + 1, min(len(t), a + 6) + 1):
                ranks.setdefault(t[a:b].encode(), len(ranks))
    library_ = tiktoken.Encoding("split", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in texts:
        assert [ranks[w.encode()] for w in split(t)] == library_.encode_ordinary(t), hex(ord(t[1]))


def test_shipped_language_statistics_match_the_definition(spark):
    """The model as learned by the query, at its own parameters, against the definition over the same texts."""
    draw = random.Random(4)
    words = {"aa": "cat dog house water 12 tree".split(), "bb": "katze hund haus wasser 34 ßaum".split()}
    rows = [(i, " ".join(draw.choice(words[x]) for _ in range(6)) + f" {x}{i}", x) for i, x in enumerate(draw.choice(list(words)) for _ in range(60))]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1))
    learned = {x: [t for i, t, lang in rows if lang == x and zlib.crc32(str(i).encode()) % 5] for x in words}
    assert model.langs == ["aa", "bb"]
    for text in ("cat hund", "zzz ÿ 99", "wasser aa3", "ß"):
        # rows are learned joined by line ends, in an order that Spark chooses: only the few grams over those ends may differ
        got, want = model.bits(text), np.array([brute_bits(learned[x], text) for x in model.langs])
        assert np.allclose(got, want, rtol=0.02), text


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, f"text {i}", f"l{i % 3}") for i in range(60)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language_id.learn(docs)
