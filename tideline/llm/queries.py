"""Queries over the corpus operators, at production parameters, with SQL for DuckDB where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tideline.llm import bpe, exact_dedup, fingerprint, language_id, mixing, pii, simhash, token_counts, toxicity, url_filter
from tideline.session import small_table, table

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return put


EXACT_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, n.text_sha256 FROM n JOIN g USING (text_sha256)
"""


@query("op5_exact_dedup", EXACT_SQL)
def op5(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op10_simhash_near_dedup")
def op10(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_language_id")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


@query("op8_token_counts")
def op8(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_toxicity")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query("op2_mixing")
def op2(spark, sf_dir):
    return mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


URL_SQL = r"""
WITH cap AS (
  SELECT page_id, nullif(regexp_replace(regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '[.]+$', ''), '') AS host,
    DATE '2024-01-01' + CAST(page_id % 365 AS INT) AS day FROM pages),
dom AS (SELECT DISTINCT regexp_replace(host, '^(www|blog|m)[.]', '') AS domain FROM cap WHERE host IS NOT NULL),
num AS (SELECT domain, ('0x' || substr(md5(domain), 1, 2))::INT AS a, ('0x' || substr(md5(domain), 3, 2))::INT AS b, ('0x' || substr(md5(domain), 5, 2))::INT AS c FROM dom),
log AS (
  SELECT CASE WHEN a % 2 = 0 THEN 'ads' ELSE 'malware' END AS list, domain, 'add' AS action, DATE '2024-01-01' + a AS day FROM num WHERE b < 160
  UNION ALL SELECT CASE WHEN a % 2 = 0 THEN 'ads' ELSE 'malware' END, domain, 'remove', DATE '2024-01-01' + a + 1 + c % 90 FROM num WHERE b < 120
  UNION ALL SELECT CASE WHEN a % 2 = 0 THEN 'ads' ELSE 'malware' END, domain, 'add', DATE '2024-01-01' + a + 31 + c % 90 FROM num WHERE b < 60
  UNION ALL SELECT 'policy', 'example.org', 'add', DATE '2024-06-01'
  UNION ALL SELECT 'policy', 'example.org', 'remove', DATE '2024-07-15'),
one AS (SELECT list, domain, day, max(action) AS action FROM log GROUP BY ALL),
iv AS (SELECT * FROM (SELECT list, domain, action, day AS valid_from, lead(day) OVER (PARTITION BY list, domain ORDER BY day) AS valid_to FROM one) WHERE action = 'add'),
hit AS (
  SELECT c.host, c.day, iv.domain, iv.list FROM (SELECT DISTINCT host, day FROM cap) c JOIN iv
  ON (c.host = iv.domain OR c.host LIKE '%.' || iv.domain) AND iv.valid_from <= c.day AND (iv.valid_to IS NULL OR c.day < iv.valid_to)),
best AS (SELECT host, day, count(*) AS n_entries, first(domain ORDER BY length(domain) DESC, domain, list) AS entry, first(list ORDER BY length(domain) DESC, domain, list) AS list FROM hit GROUP BY ALL)
SELECT page_id, cap.host, CAST(cap.day AS VARCHAR) AS day, n_entries IS NOT NULL AS blocked, coalesce(n_entries, 0) AS n_entries, entry, list
FROM cap LEFT JOIN best ON cap.host = best.host AND cap.day = best.day
"""


def dated_entries(captures):
    """A log of list entries over the hosts of the captures: added, removed and added again on days that their hashes name."""
    name = F.regexp_replace(url_filter.host(F.col("url")), "^(www|blog|m)[.]", "")
    byte = lambda at: F.conv(F.substring(F.md5("domain"), at, 2), 16, 10).cast("int")
    num = captures.select(name.alias("domain")).dropna().distinct().select("domain", byte(1).alias("a"), byte(3).alias("b"), byte(5).alias("c"))
    list_, start = F.when(F.col("a") % 2 == 0, "ads").otherwise("malware").alias("list"), F.lit("2024-01-01").cast("date")
    row = lambda below, action, after: F.when(F.col("b") < below, F.struct(F.lit(action).alias("action"), F.date_add(start, after).alias("day")))
    rows = F.array(row(160, "add", F.col("a")), row(120, "remove", F.col("a") + 1 + F.col("c") % 90), row(60, "add", F.col("a") + 31 + F.col("c") % 90))
    log = num.select(list_, "domain", F.explode(F.array_compact(rows)).alias("e")).select("list", "domain", "e.action", "e.day")
    policy = [{"list": "policy", "domain": "example.org", "action": a, "day": d} for a, d in (("add", "2024-06-01"), ("remove", "2024-07-15"))]
    fixed = small_table(captures.sparkSession, policy, "list: string, domain: string, action: string, day: string")
    return log.unionByName(fixed.withColumn("day", F.col("day").cast("date")))


@query("op9_url_filter", URL_SQL)
def op9(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")).alias("day"))
    return url_filter.evaluate(pages, dated_entries(pages)).withColumn("day", F.col("day").cast("string"))


@query("op4_pii")
def op4(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


@query("op6_fingerprint")
def op6(spark, sf_dir):
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query("op1_byte_bpe")
def op1(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
