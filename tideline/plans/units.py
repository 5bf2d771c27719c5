"""Queries of single operators: over whole tables where the operator works on rows, over fixed statements and states where
it works on these. The SQL states the expected rows by itself."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tideline.ddl import events as E
from tideline.ddl.parser import UnsupportedStatement, parse
from tideline.ddl.registry import Registry, SchemaError, bootstrap, recover, replay
from tideline.functions import text
from tideline.operators import changes, envelope, keyset, projection
from tideline.plans.config import ConfigError, settings
from tideline.plans.snapshot import SnapshotPlan, warehouse_columns
from tideline.session import small_table, table
from tideline.sinks import writers
from tideline.sources import documents, items, jdbc
from tideline.streaming.cursors import CursorReader
from tideline.streaming.offsets import TtlMap
from tideline.streaming.shard_log import ShardReader
from tideline.streaming.shards import Shard, ShardStates, discover
from tideline.types import mssql, mysql, postgres

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str):
    def put(f):
        QUERIES[name], ORACLE_SQL[name] = f, sql
        return f

    return put


def _values(columns: str, *rows: tuple) -> str:
    """SELECT of fixed rows."""
    cell = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS t({columns})"


def _rows(spark, rows: list[tuple], schema: str):
    names = [x.split(":")[0].strip() for x in schema.split(",")]
    return small_table(spark, [dict(zip(names, r, strict=True)) for r in rows], schema)


def _refused(f, *kinds) -> str:
    """'refused' where f raises one of the errors, else 'accepted'."""
    try:
        f()
    except kinds:
        return "refused"
    return "accepted"


# --- values that pass through ---


@query("pass_double", "SELECT o_orderkey, o_totalprice AS v FROM orders")
def pass_double(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", mysql.parse("double").convert(F.col("o_totalprice")).alias("v"))


@query("pass_boolean", "SELECT o_orderkey, o_totalprice > 100000 AS v FROM orders")
def pass_boolean(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", postgres.parse("boolean").convert(F.col("o_totalprice") > 100000).alias("v"))


@query("pass_bytes", "SELECT n_nationkey, hex(encode(n_name)) AS v FROM nation")
def pass_bytes(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", F.hex(mysql.parse("varbinary(30)").convert(F.col("n_name").cast("binary"))).alias("v"))


@query("pass_json", "SELECT event_id, '{\"type\":\"' || event_type || '\"}' AS v FROM events")
def pass_json(spark, sf_dir):
    made = F.concat(F.lit('{"type":"'), F.col("event_type"), F.lit('"}'))
    return table(spark, sf_dir, "events").select("event_id", mysql.parse("json").convert(made).alias("v"))


@query("enum_values", _values("declared, vals", ("enum('a','b,c','it''s')", '["a","b,c","it\'s"]'), ("set('x','Y')", '["x","Y"]'), ("ENUM('One', 'two')", '["One","two"]')))
def enum_values(spark, sf_dir):
    declared = ["enum('a','b,c','it''s')", "set('x','Y')", "ENUM('One', 'two')"]
    return _rows(spark, [(d, json.dumps(mysql.parse(d).values, separators=(",", ":"))) for d in declared], "declared: string, vals: string")


@query("bit_one_byte", "SELECT n_nationkey, n_nationkey % 2 = 1 AS v FROM nation")
def bit_one_byte(spark, sf_dir):
    byte = F.unhex(F.lpad(F.hex(F.col("n_nationkey") % 2), 2, "0"))
    return table(spark, sf_dir, "nation").select("n_nationkey", mysql.parse("bit(1)").convert(byte).alias("v"))


POINTS = [("0000000001010000000000000000000040000000000000F03F", 2.0, 1.0), ("E6100000010100000000000000000000C00000000000000000", -2.0, 0.0)]


@query("point_binary", f"SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN {POINTS[0][1]}::DOUBLE ELSE {POINTS[1][1]}::DOUBLE END AS x, CASE WHEN n_nationkey % 2 = 0 THEN {POINTS[0][2]}::DOUBLE ELSE {POINTS[1][2]}::DOUBLE END AS y FROM nation")
def point_binary(spark, sf_dir):
    data = F.unhex(F.when(F.col("n_nationkey") % 2 == 0, POINTS[0][0]).otherwise(POINTS[1][0]))
    return table(spark, sf_dir, "nation").select("n_nationkey", mysql.parse("point").convert(data).alias("p")).select("n_nationkey", "p.x", "p.y")


@query("geometry_binary", f"SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE 4326 END AS srid, CASE WHEN n_nationkey % 2 = 0 THEN '{POINTS[0][0][8:]}' ELSE '{POINTS[1][0][8:]}' END AS wkb FROM nation")
def geometry_binary(spark, sf_dir):
    """Geometries with the srid in front; struct<wkb, srid>."""
    data = F.unhex(F.when(F.col("n_nationkey") % 2 == 0, POINTS[0][0]).otherwise(POINTS[1][0]))
    return table(spark, sf_dir, "nation").select("n_nationkey", mysql.parse("geometry").convert(data).alias("g")).select("n_nationkey", "g.srid", F.hex("g.wkb").alias("wkb"))


# --- names, columns, ranges ---


@query("table_arn", "SELECT n_nationkey, 'arn:db:table/' || n_name AS arn FROM nation")
def table_arn(spark, sf_dir):
    stream = F.concat(F.lit("arn:db:table/"), F.col("n_name"), F.lit("/stream/2024"))
    return table(spark, sf_dir, "nation").select("n_nationkey", text.table_arn(stream).alias("arn"))


@query("identifiers", _values("given, bare, quoted", ("`a`", "a", "`a`"), ('"b c"', "b c", "`b c`"), ("plain", "plain", "`plain`"), ("x`y", "x`y", "`x``y`"), ("`", "`", "````")))
def identifiers(spark, sf_dir):
    given = ["`a`", '"b c"', "plain", "x`y", "`"]
    return _rows(spark, [(g, text.unescaped(g), keyset.quoted(text.unescaped(g))) for g in given], "given: string, bare: string, quoted: string")


@query("columns_by_names", "SELECT o_orderkey, o_totalprice FROM orders")
def columns_by_names(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(*projection.by_names(orders.columns, ["o_orderkey", "o_totalprice"]))


@query("column_choices", _values("choice, outcome", ("key excluded", "refused"), ("key not included", "refused"), ("both lists", "refused"), ("unknown name", "refused"), ("one excluded", "a,c"), ("two included", "a,b"), ("none", "a,b,c")))
def column_choices(spark, sf_dir):
    def of(excluded=(), included=()):
        try:
            return ",".join(projection.ColumnChoice(excluded, included).of(["a", "b", "c"], ["a"]))
        except projection.ColumnError:
            return "refused"

    rows = [("key excluded", of(("a",))), ("key not included", of((), ("b",))), ("both lists", of(("b",), ("a",))), ("unknown name", of((), ("a", "zz"))), ("one excluded", of(("b",))), ("two included", of((), ("b", "a"))), ("none", of())]
    return _rows(spark, rows, "choice: string, outcome: string")


@query("replicated_tables", "SELECT event_id, event_type AS tbl FROM events WHERE event_type IN ('click', 'view')")
def replicated_tables(spark, sf_dir):
    return projection.watched(table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("tbl")), "tbl", ["click", "view"])


@query("left_out_columns", "SELECT c_custkey, c_name FROM customer")
def left_out_columns(spark, sf_dir):
    """A column whose type can't be read is no part of the snapshot."""
    rows = [("c_custkey", "bigint", 64, 0, None, "int8", None), ("c_name", "text", None, None, None, "text", None), ("c_mktsegment", "tsvector", None, None, None, "tsvector", None)]
    kinds = jdbc.kinds_of("postgresql", rows)
    plan = SnapshotPlan("customer", ("c_custkey",), kinds, left_out=tuple(r[0] for r in rows if r[0] not in kinds))
    return plan.rows(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"))


@query("paged_scan", "SELECT c_custkey, c_nationkey FROM customer")
def paged_scan(spark, sf_dir):
    """All pages of a scan by one key, end to end, are the table; paging is for sources that can only be read so."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    low, high = keyset.fetch_bounds(rows, ["c_custkey"])
    steps = [low[0] + (high[0] - low[0]) * i // 4 for i in range(1, 5)]
    ends = list(zip([None, *steps[:-1]], steps, strict=True))
    return changes.union_all([rows.where((F.lit(True) if a is None else keyset.after(["c_custkey"], (a,), False)) & keyset.up_to(["c_custkey"], (b,))) for a, b in ends])


OVERRIDES = [
    ("int", "5", "5"), ("tinyint", "300", "refused"), ("integer", "12", "12"), ("int8", "9223372036854775807", "9223372036854775807"), ("int2", "40000", "refused"), ("numeric", "1.50", "1.50"), ("numeric", "x", "refused"),
    ("year", "2155", "2155"), ("year", "99", "refused"), ("boolean", "1", "True"), ("date", "2024-02-29", "2024-02-29"), ("date", "2024-02-30", "refused"), ("varchar", "a b", "a b"), ("bytea", "x", "refused"),
    ("uuid", "A0EEBC99-9C0B-4EF8-BB6D-6BB9BD380A11", "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"), ("double precision", "2.5", "2.5"), ("timestamp without time zone", "2024-01-01 10:00:00", "2024-01-01 10:00:00"),
]


@query("override_parsing", _values("kind, given, parsed", *OVERRIDES))
def override_parsing(spark, sf_dir):
    def parsed(kind: str, given: str) -> str:
        try:
            return str(keyset.parse_override(kind, given))
        except ValueError:
            return "refused"

    return _rows(spark, [(k, g, parsed(k, g)) for k, g, _ in OVERRIDES], "kind: string, given: string, parsed: string")


@query("key_types", _values("kind, outcome", ("integer", "accepted"), ("uuid", "accepted"), ("text", "accepted"), ("hstore", "refused"), ("json", "refused"), ("no key", "refused")))
def key_types(spark, sf_dir):
    check = lambda k: _refused(lambda: jdbc.check_keys("postgresql", [] if k == "no key" else ["k"], {"k": k}), ValueError)
    return _rows(spark, [(k, check(k)) for k in ("integer", "uuid", "text", "hstore", "json", "no key")], "kind: string, outcome: string")


@query("mssql_kinds", _values("declared, name, spark", ("bit", "bit", "boolean"), ("bigint", "bigint", "bigint")))
def mssql_kinds(spark, sf_dir):
    kinds = [(d, mssql.parse(d, None, None, None)) for d in ("bit", "bigint")]
    return _rows(spark, [(d, k.name, k.spark) for d, k in kinds], "declared: string, name: string, spark: string")


@query("server_checks", _values("setting, outcome", ("row format", "ANSI_QUOTES"), ("statement format", "refused"), ("gtid on", "true"), ("gtid off", "false")))
def server_checks(spark, sf_dir):
    rows = [
        ("row format", ",".join(jdbc.check_streaming({"binlog_format": "row", "sql_mode": "ANSI_QUOTES"}))), ("statement format", _refused(lambda: jdbc.check_streaming({"binlog_format": "STATEMENT"}), jdbc.PreflightError)),
        ("gtid on", str(jdbc.uses_gtid({"GTID_MODE": "on", "enforce_gtid_consistency": "ON"})).lower()), ("gtid off", str(jdbc.uses_gtid({"gtid_mode": "OFF"})).lower()),
    ]
    return _rows(spark, rows, "setting: string, outcome: string")


# --- events ---


@query("item_snapshot", "SELECT 'parts' AS tbl, p_partkey::VARCHAR AS id, p_name AS name, 'r' AS op FROM part")
def item_snapshot(spark, sf_dir):
    """Items of an export, tagged by type, as events."""
    name = F.to_json(F.struct(F.col("p_name").alias("S")))
    item = F.concat(F.lit('{"id":{"N":"'), F.col("p_partkey").cast("string"), F.lit('"},"name":'), name, F.lit("}"))
    events = items.snapshot(table(spark, sf_dir, "part").select(item.alias("item")), "parts", ["id"])
    return events.select(F.col("table").alias("tbl"), F.col("key.id").alias("id"), F.get_json_object("after", "$.name").alias("name"), "op")


@query("document_snapshot", "SELECT 'c' AS coll, n_nationkey::VARCHAR AS id, 'r' AS op FROM nation")
def document_snapshot(spark, sf_dir):
    line = F.concat(F.lit('{"_id":{"$numberInt":"'), F.col("n_nationkey").cast("string"), F.lit('"}}'))
    rows = table(spark, sf_dir, "nation").select(documents.key_text(line).alias("id"), line.alias("document"))
    return documents.snapshot(rows, "c").select("coll", F.col("key.id").alias("id"), "op")


@query("document_id_types", "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'number' WHEN 1 THEN 'string' ELSE 'objectId' END AS type, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey END AS number FROM nation")
def document_id_types(spark, sf_dir):
    """Ids of documents by type, as ranges compare them."""
    key = F.col("n_nationkey").cast("string")
    forms = [F.concat(F.lit('{"$numberLong":"'), key, F.lit('"}')), F.concat(F.lit('"'), key, F.lit('"')), F.concat(F.lit('{"$oid":"'), F.lpad(key, 24, "0"), F.lit('"}'))]
    made = F.concat(F.lit('{"_id":'), F.get(F.array(*forms), (F.col("n_nationkey") % 3).cast("int")), F.lit("}"))
    typed = table(spark, sf_dir, "nation").select("n_nationkey", documents.typed_id(made).alias("t"))
    return typed.select("n_nationkey", "t.type", F.col("t.number").cast("bigint").alias("number"))


@query("warehouse_columns", _values("name, kind, is_key", ("id", "int32", "true"), ("at", "io.debezium.time.MicroTimestamp", "false"), ("v", "double", "false")))
def warehouse_column_kinds(spark, sf_dir):
    schema = spark.range(0).select(F.lit(1).cast("int").alias("id"), F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(1.0).alias("v")).schema
    made = warehouse_columns([envelope.field(f.name, f.dataType) for f in schema], ["id"])
    return _rows(spark, [(c["name"], c["kind"], str(c["key"]).lower()) for c in made], "name: string, kind: string, is_key: string")


@query("resnapshot_keeps_newest", "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'alpha' ELSE 'zeta' END AS v FROM customer")
def resnapshot_keeps_newest(spark, sf_dir):
    """A table loaded twice: the later load wins, whatever its values. Target tables lie in the shared checkpoint folder."""
    import uuid

    from tideline.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    sink = writers.TableSink(spark, f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}", ["id"])
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    sink.append(customers.withColumn("v", F.lit("zeta")), [])
    sink.append(customers.where("id % 2 = 0").withColumn("v", F.lit("alpha")), [])
    return sink.read()


@query("empty_target_marked", "SELECT region.*, false AS __deleted FROM region WHERE false")
def empty_target_marked(spark, sf_dir):
    """An empty target has the source's columns and the soft-delete mark."""
    import uuid

    from tideline.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    sink = writers.TableSink(spark, f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}", ["r_regionkey"], soft_delete=True)
    sink.create_empty(table(spark, sf_dir, "region"))
    return sink.read()


@query("write_then_commit", _values("step, action", (0, "put 25"), (1, "commit"), (2, "put 5"), (3, "commit"), (4, "complete")))
def write_then_commit(spark, sf_dir):
    """Batches are written, then committed; one without rows is neither; completion runs once."""
    done: list[str] = []
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    writers.write([nations, nations.where("false"), regions], lambda b: done.append(f"put {b.count()}"), lambda: done.append("commit"), lambda: done.append("complete"))
    return _rows(spark, list(enumerate(done)), "step: int, action: string")


# --- statements ---


def _detail(e: E.Event) -> str:
    """An event's own part in words."""
    place = lambda p: " first" if isinstance(p, E.First) else f" after {p.column}" if isinstance(p, E.After) else ""
    column = lambda c: f"{c.previous_name + '>' if c.previous_name else ''}{c.name} {c.type}{' key' if c.primary_key else ''}{'' if c.default is None else '=' + c.default}{place(c.position)}"
    if isinstance(e, (E.CreateTable, E.AddColumns)):
        return "; ".join(map(column, e.columns))
    return {
        E.ModifyColumn: lambda: column(e.column), E.CopyTable: lambda: e.like, E.RenameTable: lambda: e.new_name, E.SetDefault: lambda: f"{e.column}={e.default}",
        E.DropColumn: lambda: e.column, E.RenameColumn: lambda: f"{e.old}>{e.new}", E.AddPrimaryKey: lambda: ",".join(e.columns),
    }.get(type(e), lambda: "")()


def _parsed(spark, expected: list[tuple]):
    rows = []
    for n, statement in sorted({(r[0], r[1]) for r in expected}):
        found = [(type(e).__name__, e.table, _detail(e)) for e in parse(statement)] or [("none", "", "")]
        rows += [(n, statement, i, *f) for i, f in enumerate(found)]
    return _rows(spark, rows, "n: int, statement: string, i: int, event: string, tbl: string, detail: string")


STATEMENTS = {
    "ddl_create": [
        (1, "CREATE TABLE t (id INT PRIMARY KEY, name VARCHAR(255))", 0, "CreateTable", "t", "id INT key; name VARCHAR(255)"),
        (2, "create table if not exists `db`.`t` (a int(10) unsigned auto_increment, b double, primary key (a), key idx_b (b)) engine=InnoDB", 0, "CreateTable", "t", "a int(10) unsigned key; b double"),
        (3, "CREATE TABLE t (a INT, b INT, CONSTRAINT pk PRIMARY KEY (b, a))", 0, "CreateTable", "t", "a INT key; b INT key"),
    ],
    "ddl_create_like": [(1, "CREATE TABLE n LIKE o", 0, "CopyTable", "n", "o"), (2, "CREATE TABLE n (LIKE d.o)", 0, "CopyTable", "n", "o")],
    "ddl_silent": [
        (i, s, 0, "none", "", "")
        for i, s in enumerate(["CREATE TABLE t AS SELECT * FROM x", "CREATE TABLE t (SELECT 1)", "TRUNCATE TABLE t", "ALTER TABLE t DROP INDEX i", "CREATE INDEX i ON t (a)", "DROP VIEW v", "alter table t drop foreign key fk"], 1)
    ],
    "ddl_alter": [
        (1, "ALTER TABLE t ADD COLUMN a INT FIRST, ADD b TEXT AFTER a", 0, "AddColumns", "t", "a INT first"), (1, "ALTER TABLE t ADD COLUMN a INT FIRST, ADD b TEXT AFTER a", 1, "AddColumns", "t", "b TEXT after a"),
        (2, "ALTER TABLE t CHANGE COLUMN a b BIGINT", 0, "ModifyColumn", "t", "a>b BIGINT"), (3, "ALTER TABLE t MODIFY s DECIMAL(10, 2) FIRST", 0, "ModifyColumn", "t", "s DECIMAL(10,2) first"),
        (4, "ALTER TABLE t DROP COLUMN a", 0, "DropColumn", "t", "a"), (5, "ALTER TABLE t RENAME COLUMN a TO b", 0, "RenameColumn", "t", "a>b"),
        (6, "ALTER TABLE t ADD PRIMARY KEY (a, b)", 0, "AddPrimaryKey", "t", "a,b"), (7, "ALTER TABLE t DROP PRIMARY KEY", 0, "DropPrimaryKey", "t", ""), (8, "ALTER TABLE t ALTER COLUMN a SET DEFAULT 'x'", 0, "SetDefault", "t", "a=x"),
    ],
    "ddl_drop": [(1, "DROP TABLE a", 0, "DropTable", "a", ""), (2, "DROP TABLE IF EXISTS a, `b`.c", 0, "DropTable", "a", ""), (2, "DROP TABLE IF EXISTS a, `b`.c", 1, "DropTable", "c", "")],
    "ddl_rename": [(1, "RENAME TABLE a TO b, x.c TO x.d", 0, "RenameTable", "a", "b"), (1, "RENAME TABLE a TO b, x.c TO x.d", 1, "RenameTable", "c", "d"), (2, "ALTER TABLE u RENAME TO v", 0, "RenameTable", "u", "v")],
    "ddl_table_names": [(i, f"DROP TABLE {n}", 0, "DropTable", "t", "") for i, n in enumerate(["t", "`t`", "d.t", "`d`.`t`", ".t"], 1)],
    "ddl_defaults": [
        (1, "CREATE TABLE t (a INT DEFAULT -5, b CHAR(1) DEFAULT 'x')", 0, "CreateTable", "t", "a INT=-5; b CHAR(1)=x"), (2, "CREATE TABLE t (c TIMESTAMP DEFAULT CURRENT_TIMESTAMP)", 0, "CreateTable", "t", "c TIMESTAMP"),
        (3, "CREATE TABLE t (b BOOLEAN DEFAULT TRUE)", 0, "CreateTable", "t", "b BOOLEAN=TRUE"),
    ],
}
for _name, _expected in STATEMENTS.items():
    query(_name, _values("n, statement, i, event, tbl, detail", *_expected))(lambda spark, sf_dir, expected=_expected: _parsed(spark, expected))


@query("ddl_several", _values("n, statement, i, event, tbl, detail", (1, "DROP TABLE a; RENAME TABLE b TO c", 0, "DropTable", "a", ""), (1, "DROP TABLE a; RENAME TABLE b TO c", 1, "RenameTable", "b", "c")) + " UNION ALL " + _values("n, statement, i, event, tbl, detail", (2, "FROBNICATE t", 0, "refused", "", "")))
def ddl_several(spark, sf_dir):
    """Several statements in one text; an unknown one is an error."""
    known = _parsed(spark, [(1, "DROP TABLE a; RENAME TABLE b TO c")])
    outcome = _refused(lambda: parse("FROBNICATE t"), UnsupportedStatement)
    return known.unionByName(_rows(spark, [(2, "FROBNICATE t", 0, outcome, "", "")], "n: int, statement: string, i: int, event: string, tbl: string, detail: string"))


HISTORY = [{"query": "CREATE TABLE t (id INT PRIMARY KEY, price DECIMAL(7,2), at DATETIME)", "unixTs": 10}, {"query": "ALTER TABLE t ADD COLUMN n BIGINT AFTER id", "unixTs": 20}]


@query("ddl_derived_fields", _values("name, kind, is_key", ("id", "int", "true"), ("n", "bigint", "false"), ("price", "decimal", "false"), ("at", "datetime", "false")))
def ddl_derived_fields(spark, sf_dir):
    version = replay(HISTORY).table("t")
    return _rows(spark, [(n, k.name, str(n in version.keys).lower()) for n, k in version.typed()], "name: string, kind: string, is_key: string")


@query("history_recovery", _values("what, outcome", ("replayed", "id,n,price,at"), ("newer than its offset", "refused"), ("bootstrapped", "t,u"), ("unknown table", "refused"), ("repeated column", "refused")))
def history_recovery(spark, sf_dir):
    bad = lambda q: _refused(lambda: replay(HISTORY).apply(q, 30), SchemaError)
    more, _ = bootstrap(replay(HISTORY), ["t", "u"], lambda n: f"CREATE TABLE {n} (a INT)", 30)
    rows = [
        ("replayed", ",".join(c.name for c in recover(HISTORY, 20).table("t").columns)), ("newer than its offset", _refused(lambda: recover(HISTORY, 15), SchemaError)), ("bootstrapped", ",".join(sorted(more.tables))),
        ("unknown table", bad("ALTER TABLE zz ADD a INT")), ("repeated column", bad("ALTER TABLE t ADD n INT")),
    ]
    return _rows(spark, rows, "what: string, outcome: string")


@query("registry_names", _values("tbl, columns", ("a", "id"), ("c", "id,v")))
def registry_names(spark, sf_dir):
    known = Registry().apply("CREATE TABLE a (id INT); CREATE TABLE b LIKE a; ALTER TABLE b ADD v INT; RENAME TABLE b TO c; CREATE TABLE d (x INT); DROP TABLE d", 1)
    return _rows(spark, [(n, ",".join(c.name for c in t.columns)) for n, t in known.tables.items()], "tbl: string, columns: string")


# --- shards ---


@query("shard_discovery", _values("place, shard", (0, "p"), (1, "c"), (2, "g"), (3, "x")))
def shard_discovery(spark, sf_dir):
    """Parents come before children, over all pages; what is done is not handed out."""
    states = ShardStates(TtlMap(lambda: 0.0))
    states.finish("old")
    order = discover([[Shard("c", "p"), Shard("g", "c"), Shard("old")], [Shard("p"), Shard("x", "unknown")]], states)
    return _rows(spark, [(i, s.id) for i, s in enumerate(order)], "place: int, shard: string")


@query("shard_states", _values("step, outcome", (0, "waits"), (1, "starts"), (2, "held"), (3, "free"), (4, "TRIM_HORIZON"), (5, "AFTER_SEQUENCE_NUMBER 42"), (6, "expired")))
def shard_states(spark, sf_dir):
    now = [0.0]
    states = ShardStates(TtlMap(lambda: now[0]))
    discover([[Shard("p"), Shard("c", "p")]], states)
    said = ["waits" if states.waits(Shard("c", "p")) else "free", "starts" if states.start("p") else "held", "starts" if states.start("p") else "held"]
    states.finish("p")
    said += ["waits" if states.waits(Shard("c", "p")) else "free", states.start_at("c")[0]]
    states.move("c", "42")
    said.append(" ".join(states.start_at("c")))
    now[0] = 73 * 3600.0
    said.append("kept" if states.seen("p") else "expired")
    return _rows(spark, list(enumerate(said)), "step: int, outcome: string")


# --- logs, cursors, shards as streams ---


@query("source_block", "SELECT event_id, 'mysql' AS connector, epoch_us(ts) // 1000000 * 1000 AS ts_ms, 'shop' AS db, event_type AS \"table\", 'log.' || user_id % 3 AS file, event_id AS pos, CASE WHEN event_id % 2 = 0 THEN 's:' || event_id ELSE '' END AS gtid FROM events")
def source_block(spark, sf_dir):
    """Where in the log an event was; without a transaction id the text is empty."""
    log = table(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"), F.lit("shop").alias("db"), F.col("event_type").alias("tbl"),
        F.concat(F.lit("log."), F.col("user_id") % 3).alias("shard"), F.col("event_id").alias("pos"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("s:"), "event_id")).alias("gtid"),
    )
    return log.select("event_id", envelope.log_source("mysql").alias("s")).select("event_id", "s.*")


class ListedChanges:
    """A cursor over a list of changes; tokens are their places."""

    def __init__(self, changes: list[dict], token: bytes | None):
        self.changes, self.at = changes, int(token or 0)

    def try_next(self) -> tuple[bytes, dict] | None:
        if self.at == len(self.changes):
            return None
        self.at += 1
        return str(self.at).encode(), self.changes[self.at - 1]


CHANGES = [{"operationType": k, "documentKey": {"_id": i}, "ns": {"coll": c}} for i, (k, c) in enumerate([("insert", "a"), ("update", "b"), ("delete", "a"), ("replace", "a"), ("insert", "a")])]


@query("cursor_resume", _values("batch, id, op, token", (0, "0", "insert", "Mw=="), (0, "2", "delete", "Mw=="), (1, "3", "replace", "NQ=="), (1, "4", "insert", "NQ=="), (2, "2", "delete", "NQ=="), (2, "3", "replace", "NQ=="), (2, "4", "insert", "NQ==")))
def cursor_resume(spark, sf_dir):
    """Two batches of at most two watched changes, the second by a reader that knows the token alone; then a batch between
    two tokens again."""
    reader = lambda: CursorReader(lambda kinds, before, token: ListedChanges(CHANGES, token), ["a"], 2, True)
    rows, first = reader().read({"token": ""})
    more, second = reader().read(first)
    again = reader().readBetweenOffsets({"token": "MQ=="}, second)
    got = [(n, r[1], r[0], end["token"]) for n, part, end in ((0, rows, first), (1, more, second), (2, again, second)) for r in part]
    return _rows(spark, got, "batch: int, id: string, op: string, token: string")


class ListedShards:
    """A client of shards whose records are given; an iterator is a shard and a place, a page has two records."""

    def __init__(self, shards: list[Shard], held: dict[str, list[str]], fails: int = 0):
        self.listed, self.held, self.fails = shards, held, fails

    def shards(self) -> list[list[Shard]]:
        if self.fails:
            self.fails -= 1
            raise ConnectionError("try again")
        return [[s] for s in self.listed]

    def start(self, shard: str, kind: str, seq: str | None) -> str:
        return f"{shard}:{self.held[shard].index(seq) + 1 if kind == 'AFTER_SEQUENCE_NUMBER' else 0}"

    def records(self, iterator: str, limit: int) -> tuple[list[dict], str | None]:
        shard, at = iterator.rsplit(":", 1)
        end = int(at) + 2
        page = [{"seq": s, "eventName": "INSERT", "keys": {"id": {"S": s}}, "new": {"id": {"S": s}}, "old": None, "created": None} for s in self.held[shard][int(at) : end]]
        return page, f"{shard}:{end}" if end < len(self.held[shard]) else None


@query("shard_log_batches", _values("batch, shard, seq", (0, "p", "p1"), (0, "p", "p2"), (1, "p", "p3"), (0, "x", "x1"), (2, "c", "c1")))
def shard_log_batches(spark, sf_dir):
    """A page a shard and batch: the child waits for the batch that ends its parent; one whose parent has left the log doesn't."""
    client = ListedShards([Shard("c", "p"), Shard("p"), Shard("x", "gone")], {"p": ["p1", "p2", "p3"], "c": ["c1"], "x": ["x1"]}, 2)
    reader, start, got = ShardReader(lambda: client, 1), {}, []
    for n in range(4):
        end = json.loads(json.dumps(reader.latestOffset()))
        got += [(n, r[0], r[1]) for part in reader.partitions(start, end) for r in reader.read(part)]
        start = end
    return _rows(spark, got, "batch: int, shard: string, seq: string")


@query("one_table_a_run", _values("tables, outcome", ("one", "accepted"), ("two", "refused"), ("two, allowed", "accepted")))
def one_table_a_run(spark, sf_dir):
    """A table sink takes one table, unless more are asked for."""
    of = lambda names, **more: _refused(lambda: settings({"source": "mongodb", "mongodb": {"host": "h", "database": "d", "collections": [{"name": n} for n in names]}, "destination": "table", "table": {"path": "p", **more}}), ConfigError)
    return _rows(spark, [("one", of("a")), ("two", of("ab")), ("two, allowed", of("ab", severalTables=True))], "tables: string, outcome: string")
