"""Catalogue of the engine's queries over whole tables, each with SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.functions import bits, collections, geo, numeric, tagged, temporal, text
from tideline.operators import asof, changes, envelope, keyset, projection
from tideline.plans.snapshot import SnapshotPlan
from tideline.session import small_table, table
from tideline.types import mysql

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return put


LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def tuple_sql(keys: list[str], sign: str, values: tuple) -> str:
    """A comparison of tuples, written out."""
    out = f"{keys[-1]} {sign} {values[-1]}"
    for k, v in list(zip(keys, values, strict=True))[-2::-1]:
        out = f"({k} {sign[0]} {v} OR {k} = {v} AND {out})"
    return out


# --- keyset scans ---


@query("keyset_first_page", "SELECT * FROM orders WHERE o_orderkey >= (SELECT min(o_orderkey) FROM orders) AND o_orderkey <= (SELECT max(o_orderkey) FROM orders) ORDER BY o_orderkey LIMIT 500")
def keyset_first_page(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    low, high = keyset.fetch_bounds(orders, ["o_orderkey"])
    return keyset.page(orders, ["o_orderkey"], low, high, True, 500)


@query("keyset_next_page", "SELECT * FROM orders WHERE o_orderkey > (SELECT max(k) FROM (SELECT o_orderkey AS k FROM orders ORDER BY 1 LIMIT 500)) ORDER BY o_orderkey LIMIT 500")
def keyset_next_page(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    low, high = keyset.fetch_bounds(orders, ["o_orderkey"])
    last = keyset.page(orders, ["o_orderkey"], low, high, True, 500).agg(F.max("o_orderkey")).first()[0]
    return keyset.page(orders, ["o_orderkey"], (last,), high, False, 500)


LINE_TUPLE = f"ROW({', '.join(LINE_KEYS)})"


@query("keyset_composite", f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem WHERE {LINE_TUPLE} > (SELECT min({LINE_TUPLE}) FROM lineitem) AND {LINE_TUPLE} <= (SELECT max({LINE_TUPLE}) FROM lineitem)")
def keyset_composite(spark, sf_dir):
    """All that follows a page that ended at the table's first key tuple, up to its last one."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_quantity")
    low, high = keyset.fetch_bounds(lines, LINE_KEYS)
    return lines.where(keyset.after(LINE_KEYS, low, False) & keyset.up_to(LINE_KEYS, high))


@query("keyset_range_override", f"SELECT * FROM conversations WHERE {tuple_sql(['conv_id', 'turn'], '>=', (10, 1))} AND {tuple_sql(['conv_id', 'turn'], '<=', (40, 2))}")
def keyset_range_override(spark, sf_dir):
    keys, kinds = ["conv_id", "turn"], ["bigint", "bigint"]
    start, end = (keyset.overrides(keys, kinds, x) for x in ("10,1", "40,2"))
    return table(spark, sf_dir, "conversations").where(keyset.between(keys, start, end))


@query("keyset_ranges_equal_full", "SELECT count(*) AS n, min(l_orderkey) AS lo, max(l_orderkey) AS hi, sum(l_linenumber)::BIGINT AS lines FROM lineitem")
def keyset_ranges_equal_full(spark, sf_dir):
    """Adjacent ranges, cut at key tuples, cover the table once."""
    lines = table(spark, sf_dir, "lineitem")
    low, high = keyset.fetch_bounds(lines, LINE_KEYS)
    cuts = [(low[0] + (high[0] - low[0]) * i // 4, 0, 0, 0) for i in (1, 2, 3)]
    parts = [keyset.between(LINE_KEYS, low, cuts[0])]
    parts += [keyset.after(LINE_KEYS, a, False) & keyset.up_to(LINE_KEYS, b) for a, b in zip(cuts, [*cuts[1:], high], strict=True)]
    whole = changes.union_all([lines.where(p) for p in parts])
    return whole.agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"), F.sum("l_linenumber").alias("lines"))


TUPLE_ENDS = ", ".join(f"(SELECT {k} FROM lineitem ORDER BY l_orderkey{d}, l_partkey{d}, l_suppkey{d}, l_linenumber{d} LIMIT 1) AS {n}_{k}" for d, n in (("", "min"), (" DESC", "max")) for k in LINE_KEYS)


@query("pk_bounds", f"SELECT {TUPLE_ENDS}")
def pk_bounds(spark, sf_dir):
    return keyset.bounds(table(spark, sf_dir, "lineitem"), LINE_KEYS)


@query("pk_bounds_per_column", "SELECT " + ", ".join(f"min({k}) AS min_{k}, max({k}) AS max_{k}" for k in LINE_KEYS) + " FROM lineitem")
def pk_bounds_per_column(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(*[f(k).alias(f"{n}_{k}") for k in LINE_KEYS for f, n in ((F.min, "min"), (F.max, "max"))])


# --- projection, filters, routing ---


@query("project_exclude", "SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
def project_exclude(spark, sf_dir):
    return projection.project(table(spark, sf_dir, "customer"), projection.ColumnChoice(excluded=("c_acctbal", "c_name")), ["c_custkey"])


@query("project_include", "SELECT c_custkey, c_mktsegment FROM customer")
def project_include(spark, sf_dir):
    return projection.project(table(spark, sf_dir, "customer"), projection.ColumnChoice(included=("c_mktsegment", "c_custkey")), ["c_custkey"])


@query("project_json_arrays", "SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 100)::INT)::JSON::VARCHAR AS whole FROM embeddings")
def project_json_arrays(spark, sf_dir):
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 100).cast("int"))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", projection.as_json_text(whole).alias("whole"))


EVENT_KINDS = "CASE event_id % 6 WHEN 0 THEN 'write_rows' WHEN 1 THEN 'update_rows' WHEN 2 THEN 'delete_rows' WHEN 3 THEN 'query' WHEN 4 THEN 'xid' ELSE 'rotate' END"


def event_kind():
    names = ["write_rows", "update_rows", "delete_rows", "query", "xid", "rotate"]
    return F.get(F.array(*map(F.lit, names)), (F.col("event_id") % 6).cast("int"))


@query("route_events", f"SELECT route, op, count(*) AS n FROM (SELECT CASE kind WHEN 'query' THEN 'ddl' WHEN 'xid' THEN 'ignore' WHEN 'rotate' THEN 'position' ELSE 'dml' END AS route, CASE kind WHEN 'write_rows' THEN 'c' WHEN 'update_rows' THEN 'u' WHEN 'delete_rows' THEN 'd' ELSE 'r' END AS op FROM (SELECT {EVENT_KINDS} AS kind FROM events)) GROUP BY ALL")
def route_events(spark, sf_dir):
    kinds = table(spark, sf_dir, "events").select(event_kind().alias("kind"))
    return kinds.groupBy(projection.routed(F.col("kind")).alias("route"), envelope.mapped_op(F.col("kind"), envelope.ROW_OPS, "r").alias("op")).agg(F.count(F.lit(1)).alias("n"))


@query("filter_watchlist", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def filter_watchlist(spark, sf_dir):
    return projection.watched(table(spark, sf_dir, "events"), "event_type", ["click", "purchase"]).select("event_id", "event_type")


@query("filter_database", "SELECT r_regionkey, r_name FROM region WHERE lower(r_name) = 'asia'")
def filter_database(spark, sf_dir):
    return table(spark, sf_dir, "region").where(projection.of_database(F.col("r_name"), "Asia")).select("r_regionkey", "r_name")


NOISE_SQL = "|".join(f"(?:{p})" for p in projection.NOISE).replace("'", "''")


@query("noise_filter", f"SELECT statement, count(*) AS n FROM (SELECT CASE event_id % 5 WHEN 0 THEN 'BEGIN' WHEN 1 THEN 'SAVEPOINT s' || user_id WHEN 2 THEN 'ALTER TABLE t' || user_id || ' ADD c INT' WHEN 3 THEN 'flush relay logs now' ELSE '# Dummy event replacement' END AS statement FROM events) WHERE NOT regexp_matches(statement, '{NOISE_SQL}') GROUP BY 1")
def noise_filter(spark, sf_dir):
    user = F.col("user_id").cast("string")
    made = [F.lit("BEGIN"), F.concat(F.lit("SAVEPOINT s"), user), F.concat(F.lit("ALTER TABLE t"), user, F.lit(" ADD c INT")), F.lit("flush relay logs now"), F.lit("# Dummy event replacement")]
    said = table(spark, sf_dir, "events").select(F.get(F.array(*made), (F.col("event_id") % 5).cast("int")).alias("statement"))
    return said.where(~projection.is_noise(F.col("statement"))).groupBy("statement").agg(F.count(F.lit(1)).alias("n"))


@query("zip_row_columns", "SELECT n_nationkey, n_name AS name, n_regionkey::VARCHAR AS region FROM nation")
def zip_row_columns(spark, sf_dir):
    zipped = projection.zipped(F.array(F.lit("name"), F.lit("region")), F.array("n_name", F.col("n_regionkey").cast("string")))
    rows = table(spark, sf_dir, "nation").select("n_nationkey", zipped.alias("m"))
    return rows.select("n_nationkey", F.element_at("m", "name").alias("name"), F.element_at("m", "region").alias("region"))


# --- envelopes ---


@query("snapshot_envelope_orders", "SELECT 'r' AS op, 'orders' AS src_table, o_orderkey AS key_o_orderkey, o_orderkey AS after_o_orderkey, o_custkey AS after_o_custkey, o_orderstatus AS after_o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS after_o_totalprice, epoch_us(o_orderdate) AS after_o_orderdate, o_orderpriority AS after_o_orderpriority FROM orders")
def snapshot_envelope_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    converted = {"o_orderkey": numeric.integer(F.col("o_orderkey"), "bigint"), "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"), "o_orderdate": temporal.epoch_micros(F.col("o_orderdate"))}
    rows = orders.where(keyset.between(["o_orderkey"], *keyset.fetch_bounds(orders, ["o_orderkey"])))
    events = envelope.snapshot(rows, ["o_orderkey"], "orders", F.lit(0), converted)
    after = {c: F.col(f"after.{c}") for c in orders.columns}
    after["o_totalprice"] = numeric.unscaled(after["o_totalprice"], 2).cast("bigint")
    return events.select("op", F.col("source.table").alias("src_table"), F.col("key.o_orderkey").alias("key_o_orderkey"), *[v.alias(f"after_{c}") for c, v in after.items()])


@query("snapshot_envelope_json", """SELECT 'warehouse.public.nation' AS topic, '{"schema":{"type":"","fields":null,"optional":false,"field":""},"payload":' || to_json({'n_nationkey': n_nationkey})::VARCHAR || '}' AS key,
 '{"schema":{"type":"","fields":null},"payload":' || replace(replace(replace(to_json({'before': NULL, 'after': {'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey}, 'source': {'connector': '', 'ts_ms': 1000, 'db': '', 'table': 'nation'}, 'op': 'r'})::VARCHAR, '&', '\\u0026'), '<', '\\u003c'), '>', '\\u003e') || '}' AS value FROM nation""")
def snapshot_envelope_json(spark, sf_dir):
    plan = SnapshotPlan("nation", ("n_nationkey",))
    return plan.messages(table(spark, sf_dir, "nation"), F.lit(1000), "warehouse", "public.nation")


@query("snapshot_plan_typed", "SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 100 AS BIGINT) AS unscaled, c_mktsegment FROM customer")
def snapshot_plan_typed(spark, sf_dir):
    """Declared types and excluded columns in one plan over the whole table; the decimal is decoded from its wire bytes."""
    rows = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    kinds = {"c_custkey": mysql.parse("bigint"), "c_acctbal": mysql.parse("decimal(12,2)"), "c_mktsegment": mysql.parse("varchar(10)")}
    plan = SnapshotPlan("customer", ("c_custkey",), kinds, projection.ColumnChoice(excluded=("c_name", "c_nationkey")))
    after = plan.events(rows, F.lit(0)).select("after.*")
    return after.select("c_custkey", (numeric.from_twos_complement(F.col("c_acctbal"), 2) * 100).cast("bigint").alias("unscaled"), "c_mktsegment")


@query("cdc_envelope_before_after", "SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 'd' WHEN 'click' THEN 'u' ELSE 'c' END AS op, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS before_value, value AS after_value FROM events")
def cdc_envelope_before_after(spark, sf_dir):
    events = envelope.with_before(table(spark, sf_dir, "events"), ["user_id"], ["event_id"], ["user_id", "value"])
    op = F.when(F.col("event_type") == "purchase", "d").when(F.col("event_type") == "click", "u").otherwise("c")
    made = envelope.change(events, ["user_id"], "before", "after", op, F.struct("event_id"))
    return made.select("key.user_id", "source.event_id", "op", F.col("before.value").alias("before_value"), F.col("after.value").alias("after_value"))


@query("update_pairing", "SELECT conv_id, (turn // 2)::INT AS pair, max(text) FILTER (turn % 2 = 0) AS before, max(text) FILTER (turn % 2 = 1) AS after FROM conversations GROUP BY conv_id, turn // 2 HAVING count(*) = 2")
def update_pairing(spark, sf_dir):
    """Turns of a conversation as alternating before and after rows; a turn without its partner is left out."""
    turns = table(spark, sf_dir, "conversations").withColumn("at", F.floor(F.col("turn") / 2)).groupBy("conv_id", "at").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("rows"))
    paired = turns.where(F.size("rows") == 2).select("conv_id", "at", F.explode(envelope.pair_updates(F.col("rows"))).alias("p"))
    return paired.select("conv_id", F.col("at").cast("int").alias("pair"), F.col("p.before.text").alias("before"), F.col("p.after.text").alias("after"))


@query("document_changes", """SELECT coll, key, CASE WHEN op = 'd' AND doc_id % 3 = 0 THEN NULL ELSE '{"_id":' || key || ',"v":0}' END AS before, CASE WHEN op = 'd' OR (op = 'u' AND doc_id % 5 = 0) THEN '{"_id":' || key || '}' ELSE '{"_id":' || key || ',"v":1}' END AS after, op
FROM (SELECT doc_id, 'docs' AS coll, '{"$oid":"' || md5(doc_id::VARCHAR) || '"}' AS key, CASE doc_id % 4 WHEN 0 THEN 'c' WHEN 3 THEN 'd' ELSE 'u' END AS op FROM documents)""")
def document_changes(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select("doc_id", text.document_key(F.lit("objectId"), F.md5(F.col("doc_id").cast("string"))).alias("id"))
    kind = F.get(F.array(*map(F.lit, ["insert", "update", "replace", "delete"])), (F.col("doc_id") % 4).cast("int"))
    body = lambda v: F.concat(F.lit('{"_id":'), F.col("id"), F.lit(f',"v":{v}}}'))
    gone = (kind == "delete") | (kind.isin("update", "replace") & (F.col("doc_id") % 5 == 0))
    lost = (kind == "delete") & (F.col("doc_id") % 3 == 0)
    rows = ids.select(kind.alias("operationType"), "id", F.lit("docs").alias("coll"), F.when(~gone, body(1)).alias("full"), F.when(~lost, body(0)).alias("full_before"))
    return envelope.document_change(rows)


@query("item_changes", "SELECT event_id, CASE event_type WHEN 'click' THEN 'c' WHEN 'view' THEN 'u' WHEN 'purchase' THEN 'd' ELSE 'r' END AS op, epoch_us(ts) // 1000 AS ts_ms FROM events")
def item_changes(spark, sf_dir):
    name = F.when(F.col("event_type") == "click", "INSERT").when(F.col("event_type") == "view", "MODIFY").when(F.col("event_type") == "purchase", "REMOVE").otherwise("OTHER")
    image = F.create_map(F.lit("v"), F.col("value").cast("string"))
    rows = table(spark, sf_dir, "events").select(name.alias("eventName"), F.struct("event_id").alias("keys"), F.lit(None).cast("map<string,string>").alias("old"), image.alias("new"), F.col("ts").cast("timestamp").alias("created"))
    return envelope.item_change(rows).select("key.event_id", "op", "ts_ms")


@query("topic_name", "SELECT n_nationkey, 'pre.db.' || n_name AS topic, 'db.' || n_name AS bare FROM nation")
def topic_name(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", text.topic("pre", F.lit("db"), F.col("n_name")).alias("topic"), text.topic("", F.lit("db"), F.col("n_name")).alias("bare"))


# --- scalar conversions ---


@query("decimal_unscaled", "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS unscaled FROM orders")
def decimal_unscaled(spark, sf_dir):
    price = numeric.decimal(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), 18, 2)
    return table(spark, sf_dir, "orders").select("o_orderkey", numeric.unscaled(price, 2).cast("bigint").alias("unscaled"))


HEX = "CASE WHEN length(h) % 2 = 1 THEN '0' || h ELSE h END"


@query("decimal_bytes_hex", f"SELECT p_partkey, CASE WHEN substr(e, 1, 1) >= '8' THEN '00' || e ELSE e END AS wire FROM (SELECT p_partkey, {HEX} AS e FROM (SELECT p_partkey, hex(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS h FROM part))")
def decimal_bytes_hex(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.hex(numeric.decimal_bytes(F.col("p_retailprice").cast("decimal(18,2)"), 18, 2)).alias("wire"))


@query("decimal_bytes_round_trip", "SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) AS value FROM customer UNION ALL SELECT c_custkey, CAST(CAST(-c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) FROM customer")
def decimal_bytes_round_trip(spark, sf_dir):
    """Both signs through wire bytes and back."""
    plus = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("v"))
    both = plus.unionByName(plus.select("c_custkey", (-F.col("v")).cast("decimal(18,2)").alias("v")))
    return both.select("c_custkey", (numeric.from_twos_complement(numeric.decimal_bytes(F.col("v"), 18, 2), 2) * 100).cast("bigint").alias("value"))


@query("money_parse", "SELECT c_custkey, CAST(abs(CAST(c_acctbal AS DECIMAL(18,2))) * 100 AS BIGINT) AS cents FROM customer")
def money_parse(spark, sf_dir):
    written = F.concat(F.lit("$"), F.format_number(F.abs(F.col("c_acctbal").cast("decimal(18,2)")), 2))
    return table(spark, sf_dir, "customer").select("c_custkey", numeric.unscaled(numeric.money(written), 2).cast("bigint").alias("cents"))


@query("variable_numeric", "SELECT p_partkey, 2 AS scale, CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS unscaled FROM part")
def variable_numeric(spark, sf_dir):
    value = numeric.variable_numeric(F.col("p_retailprice").cast("decimal(18,2)").cast("string"))
    rows = table(spark, sf_dir, "part").select("p_partkey", value.alias("v"))
    return rows.select("p_partkey", "v.scale", numeric.from_twos_complement(F.col("v.value"), 0).cast("bigint").alias("unscaled"))


@query("integer_narrowing", "SELECT l_linenumber::SMALLINT AS small, l_orderkey::INT AS mid, count(*) AS n FROM lineitem GROUP BY ALL")
def integer_narrowing(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(numeric.integer(F.col("l_linenumber"), "smallint").alias("small"), numeric.integer(F.col("l_orderkey"), "int").alias("mid")).agg(F.count(F.lit(1)).alias("n"))


@query("float_narrowing", "SELECT event_id, CAST(value AS FLOAT)::DOUBLE AS value FROM events")
def float_narrowing(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", numeric.float32(F.col("value")).cast("double").alias("value"))


@query("date_epoch_days", "SELECT o_orderkey, (CAST(o_orderdate AS DATE) - DATE '1970-01-01')::INT AS days FROM orders")
def date_epoch_days(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", temporal.epoch_days(F.col("o_orderdate")).alias("days"))


@query("date_zero_guard", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (CAST(o_orderdate AS DATE) - DATE '1970-01-01')::INT END AS days FROM orders")
def date_zero_guard(spark, sf_dir):
    written = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-00-dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", temporal.guarded_date(written).alias("days"))


@query("datetime_zero_guard", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS micros FROM events")
def datetime_zero_guard(spark, sf_dir):
    written = F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "0000-MM-dd HH:mm:ss")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "events").select("event_id", temporal.epoch_micros(temporal.zero_date_guard(written).cast("timestamp_ntz")).alias("micros"))


@query("ts_millis", "SELECT event_id, epoch_us(ts) // 1000 AS v FROM events")
def ts_millis(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", temporal.epoch_millis(F.col("ts")).alias("v"))


@query("ts_micros", "SELECT event_id, epoch_us(ts) AS v FROM events")
def ts_micros(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", temporal.epoch_micros(F.col("ts")).alias("v"))


@query("ts_nanos_trunc", "SELECT event_id, epoch_us(ts) * 1000 AS v FROM events")
def ts_nanos_trunc(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", temporal.epoch_nanos(F.col("ts")).alias("v"))


@query("zoned_iso", r"SELECT event_id, regexp_replace(regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '0+$', ''), '[.]$', '') || 'Z' AS v FROM events")
def zoned_iso(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", temporal.zoned_text(F.col("ts")).alias("v"))


@query("time_of_day", "SELECT event_id, ((epoch_us(ts) % 86400000000) // 1000)::INT AS ms, epoch_us(ts) % 86400000000 AS us, (epoch_us(ts) % 86400000000) * 1000 AS ns FROM events")
def time_of_day(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select("event_id", temporal.time_millis(ts).alias("ms"), temporal.time_micros(ts).alias("us"), temporal.time_nanos(ts).alias("ns"))


@query("time_text", "SELECT event_id, epoch_us(date_trunc('second', ts)) % 86400000000 AS us, ((epoch_us(date_trunc('second', ts)) % 86400000000) // 1000)::INT AS ms FROM events")
def time_text(spark, sf_dir):
    clock = F.date_format("ts", "HH:mm:ss")
    return table(spark, sf_dir, "events").select("event_id", temporal.clock_micros(clock).alias("us"), temporal.clock_millis(clock).alias("ms"))


@query("year_int", "SELECT o_orderkey, year(o_orderdate)::INT AS y FROM orders")
def year_int(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", temporal.year_number(F.year("o_orderdate")).alias("y"))


@query("interval_micros", "SELECT p_partkey, (p_size * 2629800000000 + (p_partkey % 30) * 86400000000 + p_partkey)::BIGINT AS v FROM part")
def interval_micros(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", temporal.interval_micros(F.col("p_size"), F.col("p_partkey") % 30, F.col("p_partkey")).alias("v"))


@query("timetz_utc", "SELECT event_id, strftime(date_trunc('second', ts) + INTERVAL 5 HOUR, '%H:%M:%S') || '.000000Z' AS v FROM events")
def timetz_utc(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", temporal.utc_clock(F.concat(F.date_format("ts", "HH:mm:ss"), F.lit("-05"))).alias("v"))


@query("exact_time_parse", "SELECT o_orderkey, epoch_us(date_trunc('second', o_orderdate)) AS v FROM orders")
def exact_time_parse(spark, sf_dir):
    parsed = temporal.parse_exact(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss"])
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_micros(parsed).alias("v"))


@query("event_seconds", "SELECT event_id, (epoch_us(ts) // 1000000) * 1000 AS ms FROM events")
def event_seconds(spark, sf_dir):
    whole = temporal.seconds_instant(F.unix_seconds(F.col("ts").cast("timestamp")))
    return table(spark, sf_dir, "events").select("event_id", F.unix_millis(whole).alias("ms"))


@query("bit_to_bool", "SELECT p_partkey, p_size % 2 = 1 AS v FROM part")
def bit_to_bool(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", bits.bit((F.col("p_size") % 2).cast("string"), 1).alias("v"))


@query("bit_le_bytes_hex", "SELECT p_partkey, array_to_string(list_reverse(regexp_extract_all(h, '..')), '') AS v FROM (SELECT p_partkey, CASE WHEN length(h) % 2 = 1 THEN '0' || h ELSE h END AS h FROM (SELECT p_partkey, hex(p_partkey * 1000 + p_size) AS h FROM part))")
def bit_le_bytes_hex(spark, sf_dir):
    number = F.lpad(F.bin(F.col("p_partkey") * 1000 + F.col("p_size")), 60, "0")
    return table(spark, sf_dir, "part").select("p_partkey", F.hex(bits.bit(number, 60)).alias("v"))


@query("bit_varying_hex", "SELECT p_partkey, array_to_string(list_reverse(regexp_extract_all(h, '..')), '') AS v FROM (SELECT p_partkey, CASE WHEN length(h) % 2 = 1 THEN '0' || h ELSE h END AS h FROM (SELECT p_partkey, CASE WHEN p_partkey = 0 THEN '' ELSE hex(p_partkey) END AS h FROM part))")
def bit_varying_hex(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.hex(bits.bit_varying(F.bin("p_partkey"))).alias("v"))


@query("boolean_flag", "SELECT doc_id, quality = 1 AS v FROM labels")
def boolean_flag(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", bits.flag(F.col("quality")).alias("v"))


LABELS = ["alpha", "beta", "it's", "a,b"]


@query("enum_index_label", "SELECT event_id, ['alpha', 'beta', 'it''s', 'a,b'][(event_id % 4)::INT + 1] AS v FROM events")
def enum_index_label(spark, sf_dir):
    kind = mysql.parse("ENUM('alpha','beta','it''s','a,b')")
    return table(spark, sf_dir, "events").select("event_id", kind.convert(F.col("event_id") % 4).alias("v"))


@query("set_mask_labels", "SELECT event_id, array_to_string(list_filter([CASE WHEN event_id & 1 = 1 THEN 'x' END, CASE WHEN event_id & 2 = 2 THEN 'y' END, CASE WHEN event_id & 4 = 4 THEN 'z' END], lambda v: v IS NOT NULL), ',') AS v FROM events")
def set_mask_labels(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", collections.set_labels(F.col("event_id") % 8, ["x", "y", "z"]).alias("v"))


@query("uuid_canonical", "SELECT doc_id, substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21, 12) AS v FROM (SELECT doc_id, md5(doc_id::VARCHAR) AS m FROM documents)")
def uuid_canonical(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.uuid(F.upper(F.md5(F.col("doc_id").cast("string")))).alias("v"))


@query("hstore_drop_null", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS n, event_type AS t FROM events")
def hstore_drop_null(spark, sf_dir):
    pairs = F.create_map(F.lit("t"), F.col("event_type"), F.lit("v"), F.when(F.col("event_id") % 2 == 0, F.col("value").cast("string")))
    rows = table(spark, sf_dir, "events").select("event_id", collections.without_nulls(pairs).alias("m"))
    return rows.select("event_id", F.size("m").alias("n"), F.element_at("m", "t").alias("t"))


@query("array_json_elements", """SELECT event_id, '{"k":' || event_id || '}' AS object, event_type AS word FROM events""")
def array_json_elements(spark, sf_dir):
    listed = F.concat(F.lit('[{"k":'), F.col("event_id"), F.lit('},"'), F.col("event_type"), F.lit('"]'))
    rows = table(spark, sf_dir, "events").select("event_id", collections.json_texts(listed).alias("a"))
    return rows.select("event_id", F.get("a", F.lit(0)).alias("object"), F.get("a", F.lit(1)).alias("word"))


@query("point_parse", "SELECT c_custkey, c_custkey::DOUBLE + 0.5::DOUBLE AS x, 0.25::DOUBLE - c_custkey::DOUBLE AS y FROM customer")
def point_parse(spark, sf_dir):
    written = F.concat(F.lit("("), F.col("c_custkey"), F.lit(".5,"), (-F.col("c_custkey") + 0.25).cast("string"), F.lit(")"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", geo.point(written).alias("p"))
    return rows.select("c_custkey", "p.x", "p.y")


@query("geo_wkb_base64", "SELECT c_custkey, to_base64(encode(c_name)) AS wkb, NULL::INT AS srid FROM customer")
def geo_wkb_base64(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", geo.hex_geometry(F.hex("c_name")).alias("g"))
    return rows.select("c_custkey", "g.wkb", "g.srid")


@query("tagged_json_decode", """SELECT event_id, '{"id":"' || event_id || '","k":' || (json_extract(props, '$.k'))::VARCHAR || '.0}' AS item, '{"id":"string","k":"float"}' AS schema, (json_extract(props, '$.k'))::DOUBLE AS k FROM events""")
def tagged_json_decode(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    item = F.concat(F.lit('{"id":{"S":"'), F.col("event_id"), F.lit('"},"gone":{"NULL":true},"k":{"N":"'), k, F.lit('"}}'))
    rows = table(spark, sf_dir, "events").select("event_id", item.alias("raw"))
    decoded = tagged.decode(F.col("raw"))
    return rows.select("event_id", F.replace(decoded, F.lit('"gone":null,'), F.lit("")).alias("item"), tagged.schema(F.col("raw")).alias("schema"), tagged.number(F.col("raw"), "k").alias("k"))


@query("document_key_text", """SELECT doc_id, '{"$oid":"' || md5(text) || '"}' AS oid, doc_id::VARCHAR AS num FROM documents""")
def document_key_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.document_key(F.lit("objectId"), F.md5("text")).alias("oid"), text.document_key(F.lit("int"), F.col("doc_id").cast("string")).alias("num"))


# --- joins, replay, state ---


@query("gtid_replay_filter", "SELECT user_id, event_id FROM events JOIN (SELECT user_id AS u, max(event_id) AS stop FROM events WHERE event_id % 10 = 0 GROUP BY 1) ON u = user_id WHERE event_id >= stop UNION ALL SELECT user_id, event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 10 = 0)")
def gtid_replay_filter(spark, sf_dir):
    """Servers are users, transactions are events; every tenth transaction has been seen."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id")
    seen = events.where(F.col("event_id") % 10 == 0).select("user_id", F.col("event_id").alias("stop"))
    return changes.not_replayed(events, seen, "user_id", "event_id", "stop")


@query("gtid_parts", "SELECT DISTINCT 'u' || user_id AS sid, max(event_id) OVER (PARTITION BY user_id) AS highest FROM events")
def gtid_parts(spark, sf_dir):
    sid, tx = changes.transaction(F.concat(F.lit("u"), F.col("user_id"), F.lit(":"), F.col("event_id")))
    return changes.highest(table(spark, sf_dir, "events").select(sid.alias("sid"), tx.alias("tx")), "sid", "tx")


@query("stale_event_drop", "SELECT event_id, event_type FROM events JOIN (SELECT event_type AS t, max(event_id) AS since FROM events WHERE event_id % 7 = 3 AND event_id < 500 GROUP BY 1) ON t = event_type WHERE since <= event_id")
def stale_event_drop(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    schemas = events.where((F.col("event_id") % 7 == 3) & (F.col("event_id") < 500)).select("event_type", F.col("event_id").alias("since"))
    return changes.not_stale(events, schemas, ["event_type"], "event_id", "since")


@query("asof_lookup", "SELECT e.event_id, p.event_id AS price_id, p.value AS price FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts")
def asof_lookup(spark, sf_dir):
    """For each event the user's latest purchase at or before it."""
    events = table(spark, sf_dir, "events")
    prices = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("price_id"), F.col("value").alias("price"))
    return asof.as_of(events.select("user_id", "ts", "event_id"), prices, ["user_id"], "ts", "at", ["price_id", "price"]).select("event_id", "price_id", "price")


@query("asof_without_key", "SELECT o.o_orderkey, e.event_id FROM orders o ASOF LEFT JOIN (SELECT ts - INTERVAL 25 YEAR AS ts, event_id FROM events) e ON o.o_orderdate >= e.ts")
def asof_without_key(spark, sf_dir):
    items = table(spark, sf_dir, "events").select((F.col("ts") - F.expr("INTERVAL 25 YEARS")).alias("at"), "event_id")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return asof.bucketed_as_of(orders, items, [], "o_orderdate", "at", ["event_id"], 30 * 86_400).select("o_orderkey", "event_id")


@query("asof_hot_key", "SELECT e.event_id, p.event_id AS price_id FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON (e.user_id % 2) = (p.user_id % 2) AND e.ts >= p.ts")
def asof_hot_key(spark, sf_dir):
    """Two keys hold all events; buckets of a day spread them."""
    events = table(spark, sf_dir, "events").withColumn("side", F.col("user_id") % 2)
    prices = events.where("event_type = 'purchase'").select("side", F.col("ts").alias("at"), F.col("event_id").alias("price_id"))
    return asof.bucketed_as_of(events.select("side", "ts", "event_id"), prices, ["side"], "ts", "at", ["price_id"], 86_400).select("event_id", "price_id")


@query("shard_lineage_ready", "SELECT s.n_nationkey AS shard FROM nation s LEFT JOIN nation p ON p.n_nationkey = s.n_nationkey - 5 WHERE s.n_nationkey % 4 <> 0 AND NOT coalesce(p.n_regionkey <> 2 AND p.n_nationkey % 4 <> 0, FALSE)")
def shard_lineage_ready(spark, sf_dir):
    """Nations are shards whose parent is five before; every fourth is processed, those of region 2 were never seen."""
    shards = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("shard"), (F.col("n_nationkey") - 5).alias("parent"), (F.col("n_regionkey") != 2).alias("seen"), (F.col("n_nationkey") % 4 == 0).alias("processed"))
    return changes.ready_shards(shards, "shard", "parent", "seen", "processed").select("shard")


@query("ttl_live_keys", "SELECT event_id FROM events WHERE ts + INTERVAL 72 HOUR > (SELECT max(ts) FROM events) - INTERVAL 1 DAY")
def ttl_live_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    now = events.agg(F.max("ts") - F.expr("INTERVAL 1 DAY")).first()[0]
    return changes.live(events, "ts", 72 * 3600, F.lit(now).cast("timestamp_ntz")).select("event_id")


# --- applying changes ---


@query("append_dedupe_latest", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1")
def append_dedupe_latest(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return changes.latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]).drop("l_shipdate")


ORDER_CHANGES = "SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, CASE o_orderkey % 3 WHEN 0 THEN 'd' ELSE 'u' END AS op FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice, 'c' FROM orders WHERE o_orderkey % 50 = 1"


def order_changes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    old = orders.where(F.col("o_orderkey") % 5 == 0).select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.when(F.col("o_orderkey") % 3 == 0, "d").otherwise("u").alias("op"))
    new = orders.where(F.col("o_orderkey") % 50 == 1).select((-F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", "o_totalprice", F.lit("c").alias("op"))
    return orders, old.unionByName(new).withColumn("pos", F.lit(1))


@query("merge_upsert", f"WITH c AS ({ORDER_CHANGES}) SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c) UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM c WHERE op <> 'd'")
def merge_upsert(spark, sf_dir):
    orders, found = order_changes(spark, sf_dir)
    return changes.merge(orders, found, ["o_orderkey"], "op", ["pos"])


@query("merge_keeping_deletes", f"WITH c AS ({ORDER_CHANGES}) SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c) UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM c")
def merge_keeping_deletes(spark, sf_dir):
    orders, found = order_changes(spark, sf_dir)
    return changes.merge(orders, found, ["o_orderkey"], "op", ["pos"], delete=False)


@query("soft_delete_flag", f"WITH c AS ({ORDER_CHANGES}) SELECT o_orderkey, o_custkey, o_totalprice, o_orderkey IN (SELECT o_orderkey FROM c WHERE op = 'd') AS deleted FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c WHERE op <> 'd') UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, FALSE FROM c WHERE op <> 'd'")
def soft_delete_flag(spark, sf_dir):
    orders, found = order_changes(spark, sf_dir)
    return changes.soft_delete(orders, found, ["o_orderkey"], "op", ["pos"], "deleted")


@query("empty_table_schema", "SELECT * FROM region WHERE false")
def empty_table_schema(spark, sf_dir):
    return keyset.empty_like(table(spark, sf_dir, "region"))


@query("batch_by_bytes", "SELECT source, batch, count(*) AS n, sum(b)::BIGINT AS bytes FROM (SELECT source, b, (sum(b) OVER (PARTITION BY source ORDER BY doc_id) - 1)::BIGINT // 100000 AS batch FROM (SELECT source, doc_id, strlen(coalesce(text, '')) + 1 AS b FROM documents)) GROUP BY ALL")
def batch_by_bytes(spark, sf_dir):
    """Documents of a source dealt to messages of about 100 kB; windows hold sizes only, not texts."""
    sizes = table(spark, sf_dir, "documents").select("source", "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("b"))
    dealt = changes.batches_by_bytes(sizes, F.col("b"), ["doc_id"], 100_000, "source")
    return dealt.groupBy("source", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("bytes"))


COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("observed_counts", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in COUNTED))
def observed_counts(spark, sf_dir):
    return changes.union_all([table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n") for t in COUNTED])


@query("schema_versions_join", "SELECT event_id, CASE WHEN event_id >= 600 THEN 3 WHEN event_id >= 300 THEN 3 WHEN event_id >= 100 THEN 2 END AS n_columns FROM events")
def schema_versions_join(spark, sf_dir):
    """Events as of the schema version that a replayed history gives; the version log is a few rows."""
    from tideline.ddl.registry import versions

    history = [
        {"query": "CREATE TABLE t (id INT PRIMARY KEY, name VARCHAR(20))", "unixTs": 100},
        {"query": "ALTER TABLE t ADD COLUMN age INT AFTER id", "unixTs": 300},
        {"query": "ALTER TABLE t CHANGE COLUMN name full_name VARCHAR(40)", "unixTs": 600},
    ]
    log = small_table(spark, versions(history), "table: string, since: bigint, columns: string").select("since", F.size(F.from_json("columns", "array<string>")).alias("n_columns"))
    ends = log.withColumn("until", F.lead("since").over(Window.orderBy("since")))
    events = table(spark, sf_dir, "events").select("event_id")
    # versions of one table, a handful of rows whatever the events
    return events.join(F.broadcast(ends), (F.col("event_id") >= F.col("since")) & (F.col("until").isNull() | (F.col("event_id") < F.col("until"))), "left").select("event_id", "n_columns")
