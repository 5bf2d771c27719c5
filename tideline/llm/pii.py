"""Personal data: fixed patterns, and bootstrapped contextual extraction on top of them. DataFrame and SQL functions only.

Base spans are the matches of four patterns (email, ip, card, phone) that pass their checks. They seed a graph of lexical
patterns and instances: a pattern is the token left or right of a value, an instance is a value that looks like an
identifier. A pattern's confidence in a kind is the scored share of all that stands beside it, over all documents. A
pattern with enough sure instances and confidence holds; it marks the instances beside it, as sure as the patterns that
hold them make them, and these induce further patterns in the next round, until a round changes nothing. Held patterns
then mark the values beside them that no base span covers. A common word before an address stands before too much else
to become a pattern.

Defined results: a null text counts as empty; positions are code points, ends exclusive; of spans with the same start the
kind listed first comes first; where patterns of several kinds mark a value the most confident names its kind, and on
ties the kind that is last by name; a token of more than CONTEXT characters is no pattern; rows that repeat a doc_id give
one result row each, those of one doc_id and text being counted once in the graph's scores; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import once
from tideline.session import settled

KINDS = ("email", "ip", "card", "phone")
#: The contract's patterns. Starts inside a run that has just failed can't succeed, so a match starts where a run starts
#: or the last match ended (\G); possessive quantifiers where nothing that follows could make use of a shorter match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: What looks like an identifier where no base pattern holds: digits with separators, and masked addresses.
LOOSE = {
    "number": r"(?<![A-Za-z0-9])[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+(?![A-Za-z0-9])",
    "address": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:\x20?(?:\(at\)|\[at\])\x20?|@)[A-Za-z0-9-]++",
}
CONTEXT = 64  # characters of a pattern's token at most
LEAST_SEEDS = 4  # distinct sure instances of a pattern
CONFIDENCE = 0.7  # of a pattern that holds, and of a sure instance
ROUNDS = 12  # of induction at most; it mostly ends after a few, when neither patterns nor their confidence change
SIDES = ("left", "right")
CHUNK = 256
BROADCAST_ROWS = 100_000  # patterns that are broadcast at most, some 10 MB

SPAN = "struct<start: bigint, end: bigint, value: string, before: string, after: string>"


def _cumulated(steps: Column) -> Column:
    """Sum of all elements before each one; in chunks, so that many elements cost no quadratic copying."""
    chunks = F.sequence(F.lit(0), F.ceil(F.size(steps) / CHUNK).cast("int") - 1)
    plus = lambda a, x: a + x

    def chunk(c: Column) -> Column:
        start = F.array(F.aggregate(F.slice(steps, F.lit(1), c * CHUNK), F.lit(0).cast("long"), plus))
        part = F.slice(steps, c * CHUNK + 1, F.lit(CHUNK))
        sums = F.aggregate(part, start, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return F.slice(sums, F.lit(1), F.size(part))

    return F.flatten(F.transform(chunks, chunk))


def matches(text: Column, pattern: str, needs: Column | None = None) -> Column:
    """All leftmost non-overlapping matches as SPAN: positions, the value, and the text before and after it (at most 2 * CONTEXT)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if needs is not None:
        found = F.when(needs, found).otherwise(F.array().cast("array<string>"))
    none = F.array().cast(f"array<{SPAN}>")

    def placed(values: Column) -> Column:
        def between(gaps: Column) -> Column:
            steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: (F.length(g) + F.length(v)).cast("long"))

            def span(starts: Column, i: Column) -> Column:
                gap, value = F.get(gaps, i), F.get(values, i)
                start = F.get(starts, i) + F.length(gap)
                earlier = F.when(i > 0, F.concat(F.get(values, i - 1), gap)).otherwise(gap)
                before = F.right(F.when(F.length(gap) < 2 * CONTEXT, earlier).otherwise(gap), F.lit(2 * CONTEXT))
                later = F.get(gaps, i + 1)
                after = F.left(F.when(F.length(later) < 2 * CONTEXT, F.concat(later, F.coalesce(F.get(values, i + 1), F.lit("")))).otherwise(later), F.lit(2 * CONTEXT))
                return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), before.alias("before"), after.alias("after"))

            return once(once(steps, _cumulated), lambda starts: F.transform(F.sequence(F.lit(0), F.size(values) - 1), lambda i: span(starts, i)))

        return once(F.split(text, pattern, -1), between)

    return once(found, lambda v: F.when(F.size(v) > 0, placed(v)).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def weighed(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    sums = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), weighed)
    return F.when(F.length(digits).between(14, 19), sums % 10 == 0).otherwise(F.lit(False))


def _byte(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+", "")
    return F.when(F.length(short) <= 3, F.when(short == "", 0).otherwise(short.cast("int")) <= 255).otherwise(F.lit(False))


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"[.]"), _byte),
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(10, 15),
}


def _base(text: Column) -> Column:
    """Base spans of all kinds as (start, rank of the kind, kind, end, value, before, after)."""
    def kind(rank: int, name: str) -> Column:
        needs = F.contains(text, F.lit(NEEDS[name])) if NEEDS[name] else None
        good = F.filter(matches(text, BASE[name], needs), lambda s: CHECKS[name](s["value"]))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(name).alias("kind"), s["end"].alias("end"), s["value"].alias("value"), s["before"].alias("before"), s["after"].alias("after")))

    return F.concat(*[kind(i, k) for i, k in enumerate(KINDS)])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _context(span: Column, side: str) -> Column:
    """The token on that side of a value, lower case; empty at a text's end, or where the token is too long."""
    if side == "left":
        return F.lower(F.regexp_extract(span["before"], rf"(?<!\S)(\S{{1,{CONTEXT}}})\s*$", 1))
    return F.lower(F.regexp_extract(span["after"], rf"^\s*(\S{{1,{CONTEXT}}})(?!\S)", 1))


def _beside(spans: DataFrame, *more: Column) -> DataFrame:
    """side, context and more of spans s, a row for each side that has a token."""
    sides = F.array(*[F.struct(F.lit(x).alias("side"), _context(F.col("s"), x).alias("context")) for x in SIDES])
    return spans.select(F.explode(sides).alias("c"), *more).select("c.side", "c.context", *[F.col(n) for n in spans.select(*more).columns]).where("context != ''")


def _candidates(text: Column, base: Column) -> Column:
    """What looks like an identifier and no base span covers: start, end, value, before, after, shape."""
    def shape(name: str) -> Column:
        needs = F.contains(text, F.lit("at")) | F.contains(text, F.lit("@")) if name == "address" else None
        free = F.filter(matches(text, LOOSE[name], needs), lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
        return F.transform(free, lambda c: F.struct(c["start"], c["end"], c["value"], c["before"], c["after"], F.lit(name).alias("shape")))

    return F.concat(*[shape(n) for n in LOOSE])


def _shape(kind: Column) -> Column:
    return F.when(kind == "email", "address").otherwise("number")


def _read(docs: DataFrame) -> DataFrame:
    """row, doc_id, hashed (of the text), base and candidates; written once, without the texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("base", _base(F.col("text")))
    read = read.withColumn("free", _candidates(F.col("text"), F.col("base")))
    return settled(read.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("hashed"), "base", "free"))


def _neighbours(docs: DataFrame, named: DataFrame) -> DataFrame:
    """(side, context, stands): how often each context of `named` has a token on its other side, over all texts."""
    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    tokens = F.filter(F.split(text, r"\s+", -1), lambda w: w != "")
    words = docs.select(tokens.alias("t")).select(F.size("t").alias("of"), F.posexplode("t").alias("at", "context")).where(F.length("context") <= CONTEXT)
    counts = [F.count(F.when(F.col("at") < F.col("of") - 1, 1)).alias("left"), F.count(F.when(F.col("at") > 0, 1)).alias("right")]
    asked = named.select("context").distinct()
    if asked.count() <= BROADCAST_ROWS:
        counted = words.join(F.broadcast(asked), "context").groupBy("context").agg(*counts)
    else:
        counted = words.groupBy("context").agg(*counts).join(asked, "context", "left_semi")
    return counted.unpivot("context", list(SIDES), "side", "stands")


def learn(docs: DataFrame, read: DataFrame) -> DataFrame:
    """(side, context, shape, kind, confidence) of the patterns that hold."""
    distinct = read.select("doc_id", "hashed", "base", "free").dropDuplicates(["doc_id", "hashed"])
    value = F.lower("s.value").alias("value")
    seeds = _beside(distinct.select(F.explode("base").alias("s")), _shape(F.col("s.kind")).alias("shape"), value, F.col("s.kind").alias("known"))
    loose = _beside(distinct.select(F.explode("free").alias("s")), F.col("s.shape").alias("shape"), value, F.lit(None).cast("string").alias("known"))
    edges = settled(seeds.unionByName(loose).groupBy("side", "context", "shape", "value").agg(F.max("known").alias("known"), F.count(F.lit(1)).alias("n")))
    place = ["side", "context", "shape"]
    held = edges.groupBy(*place).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values")).where(F.col("values") >= LEAST_SEEDS)
    held = settled(held)
    totals = held.join(_neighbours(docs, held), ["side", "context"], "left")
    # all that a pattern stands beside: its values, and one for each occurrence of anything else
    totals = settled(totals.select(*place, (F.col("values") + F.greatest(F.coalesce("stands", F.lit(0)) - F.col("n"), F.lit(0)) + 1).alias("all")))
    graph = settled(edges.join(totals.select(*place), place, "left_semi").select(*place, "value"))
    known = settled(edges.where("known is not null").select("shape", "value", F.col("known").alias("kind"), F.lit(1.0).alias("score")).distinct())
    scores, before, patterns = known, None, None
    for _ in range(ROUNDS):
        sure = graph.join(scores, ["shape", "value"]).groupBy(*place, "kind").agg(F.sum("score").alias("sure"), F.count(F.when(F.col("score") >= CONFIDENCE, 1)).alias("seeds"))
        rated = sure.join(totals, place).select(*place, "kind", (F.col("sure") / F.col("all")).alias("confidence"), "seeds").where((F.col("confidence") >= CONFIDENCE) & (F.col("seeds") >= LEAST_SEEDS))
        best = rated.groupBy(*place).agg(F.max(F.struct("confidence", "kind")).alias("b"))
        patterns = settled(best.select(*place, "b.kind", "b.confidence"))
        found = patterns.agg(F.count(F.lit(1)), F.round(F.coalesce(F.sum("confidence"), F.lit(0.0)), 2)).first()
        if found == before:
            break
        before = found
        doubt = F.exp(F.sum(F.ln(1 - F.least(F.col("confidence"), F.lit(0.999)))))
        marked = graph.join(patterns, place).groupBy("shape", "value", "kind").agg((1 - doubt).alias("score"))
        scores = settled(known.unionByName(marked).groupBy("shape", "value", "kind").agg(F.max("score").alias("score")))
    return patterns


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and learned)."""
    read = _read(docs)
    patterns = settled(learn(docs, read))
    free = _beside(read.select("row", F.explode("free").alias("s")), F.col("row"), F.col("s.shape").alias("shape"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    held = F.broadcast(patterns) if patterns.count() <= BROADCAST_ROWS else patterns
    rank = reduce(lambda c, x: c.when(F.col("kind") == x[1], x[0]), list(enumerate(KINDS))[1:], F.when(F.col("kind") == KINDS[0], 0))
    marked = free.join(held, ["side", "context", "shape"]).groupBy("row", "start", "end").agg(F.max(F.struct("confidence", "kind")).alias("b")).select("row", "start", "end", "b.kind")
    # a text's learned spans are no more than its own values
    more = settled(marked.select("row", F.struct("start", rank.alias("rank"), "kind", "end").alias("span")).groupBy("row").agg(F.collect_list("span").alias("more")))
    plain = F.transform("base", lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"]))
    empty = F.array().cast("array<struct<start: bigint, rank: int, kind: string, end: bigint>>")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return read.join(more, "row", "left").select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(_joined(plain).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat(plain, F.coalesce("more", empty))).alias("spans"),
    )
