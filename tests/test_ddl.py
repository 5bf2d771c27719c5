"""Statements to events, and events to schemas."""

import pytest

from tideline.ddl import events as E
from tideline.ddl.events import ColumnDef as C
from tideline.ddl.parser import UnsupportedStatement, parse
from tideline.ddl.registry import Registry, SchemaError, bootstrap, recover, versions
from tideline.operators.projection import ColumnChoice

CREATED = [
    ("CREATE TABLE t (id INT);", [C("id", "INT")]),
    ("CREATE TABLE t (price DECIMAL(10, 2) DEFAULT 99.99);", [C("price", "DECIMAL(10,2)", "99.99")]),
    ("CREATE TABLE t (n INT DEFAULT -5 NOT NULL);", [C("n", "INT", "-5")]),
    ("CREATE TABLE t (b BOOLEAN DEFAULT TRUE);", [C("b", "BOOLEAN", "TRUE")]),
    ("CREATE TABLE t (c TIMESTAMP DEFAULT CURRENT_TIMESTAMP ON UPDATE CURRENT_TIMESTAMP);", [C("c", "TIMESTAMP")]),
    ("CREATE TABLE t (c DATETIME(3) DEFAULT CURRENT_TIMESTAMP(3));", [C("c", "DATETIME(3)")]),
    ("CREATE TABLE t (s ENUM('a', 'b,c', 'it''s') DEFAULT 'a');", [C("s", "ENUM('a','b,c','it''s')", "a")]),
    ("""CREATE TABLE t (j JSON DEFAULT '{"key": "value"}');""", [C("j", "JSON", '{"key": "value"}')]),
    ("CREATE TABLE `db`.`t` (`id` INT PRIMARY KEY, name VARCHAR(255) CHARACTER SET utf8mb4 COLLATE utf8mb4_bin COMMENT 'it''s; a (name)')", [C("id", "INT", None, True), C("name", "VARCHAR(255)")]),
    ("create table if not exists t (a int(10) unsigned auto_increment, b double precision, primary key (a), key idx_b (b), constraint u unique (b)) engine=InnoDB default charset=utf8", [C("a", "int(10) unsigned", None, True), C("b", "double precision")]),
    ("CREATE TABLE t (a INT, b INT, CONSTRAINT pk PRIMARY KEY USING BTREE (b, a(10)), FOREIGN KEY (a) REFERENCES x (y) ON DELETE CASCADE) PARTITION BY HASH(a) PARTITIONS 4", [C("a", "INT", None, True), C("b", "INT", None, True)]),
    ("CREATE TABLE t (a INT GENERATED ALWAYS AS (b + 1) VIRTUAL, b INT, v VECTOR(3)) -- done", [C("a", "INT"), C("b", "INT"), C("v", "VECTOR(3)")]),
]


@pytest.mark.parametrize(("text", "columns"), CREATED)
def test_create(text, columns):
    assert parse(text) == [E.CreateTable("t", tuple(columns))]


SILENT = [
    "TRUNCATE TABLE foo;", "ALTER TABLE t DROP INDEX i;", "ALTER TABLE t ADD INDEX i (a, b);", "alter table t alter index i visible;", "alter table t rename index a to b;",
    "ALTER TABLE t ADD CONSTRAINT c UNIQUE (a, b);", "ALTER TABLE t DROP CONSTRAINT c;", "alter table t add partition (partition p1 values less than (737425) engine = InnoDB);",
    "alter table t stats_auto_recalc=default, stats_sample_pages=50;", "alter table t drop foreign key fk;", "alter table t add foreign key (a) references x (b);", "alter table t add check (a > 0);",
    "alter table t alter check c1 enforced;", "CREATE INDEX i ON t (a)", "CREATE TABLE t AS SELECT * FROM x", "CREATE TABLE t (SELECT 1)", "DROP VIEW v", "CREATE TEMPORARY TABLE t (a INT)", "", ";;",
]


@pytest.mark.parametrize("text", SILENT)
def test_silent(text):
    assert parse(text) == []


ALTERED = [
    ("ALTER TABLE e MODIFY COLUMN s DECIMAL(10, 2) FIRST;", [E.ModifyColumn("e", C("s", "DECIMAL(10,2)", position=E.First()))]),
    ("alter table s add column a varchar(150) first, add b int after c;", [E.AddColumns("s", (C("a", "varchar(150)", position=E.First()),)), E.AddColumns("s", (C("b", "int", position=E.After("c")),))]),
    ("alter table t3 add column (c2 decimal(10, 2) comment 'comment`' null, c3 enum('abc', 'cba')), ADD COLUMN c4 varchar(255) FIRST", [E.AddColumns("t3", (C("c2", "decimal(10,2)"), C("c3", "enum('abc','cba')"))), E.AddColumns("t3", (C("c4", "varchar(255)", position=E.First()),))]),
    ("ALTER TABLE `order` ADD cancelled TINYINT(1) DEFAULT 0 NOT NULL, DROP COLUMN `x`, DROP y", [E.AddColumns("order", (C("cancelled", "TINYINT(1)", "0"),)), E.DropColumn("order", "x"), E.DropColumn("order", "y")]),
    ("alter table default.task add column xxxx varchar(200) comment 'cdc test';", [E.AddColumns("task", (C("xxxx", "varchar(200)"),))]),
    ("ALTER TABLE .t ADD COLUMN id INT", [E.AddColumns("t", (C("id", "INT"),))]),
    ("alter table goods add column `id` int(10) unsigned primary KEY AUTO_INCREMENT;", [E.AddColumns("goods", (C("id", "int(10) unsigned", None, True),))]),
    ("alter table t5 rename column `old` to `new`;", [E.RenameColumn("t5", "old", "new")]),
    ("alter table t change column a b bigint not null default 3 after c", [E.ModifyColumn("t", C("b", "bigint", "3", position=E.After("c"), previous_name="a"))]),
    ("ALTER TABLE u ALTER COLUMN s SET DEFAULT 'x';", [E.SetDefault("u", "s", "x")]),
    ("ALTER TABLE u ALTER s DROP DEFAULT;", [E.SetDefault("u", "s", None)]),
    ("ALTER TABLE u ADD PRIMARY KEY (a, b);", [E.AddPrimaryKey("u", ("a", "b"))]),
    ("ALTER TABLE u DROP PRIMARY KEY", [E.DropPrimaryKey("u")]),
    ("ALTER TABLE u RENAME TO v", [E.RenameTable("u", "v", True)]),
    ("DROP TABLE IF EXISTS a, `b`.c;", [E.DropTable("a"), E.DropTable("c")]),
    ("RENAME TABLE a TO b, x.c TO x.d", [E.RenameTable("a", "b"), E.RenameTable("c", "d")]),
    ("CREATE TABLE n LIKE o", [E.CopyTable("n", "o")]),
    ("CREATE TABLE n (LIKE o)", [E.CopyTable("n", "o")]),
    ("DROP TABLE a; RENAME TABLE b TO c", [E.DropTable("a"), E.RenameTable("b", "c")]),
]


@pytest.mark.parametrize(("text", "events"), ALTERED)
def test_alter(text, events):
    assert parse(text) == events


def test_unknown_statement():
    with pytest.raises(UnsupportedStatement):
        parse("FROBNICATE t")


BASE = Registry().apply("CREATE TABLE test_table (id INT PRIMARY KEY, name VARCHAR(255), email VARCHAR(255));", 99)
names = lambda r, t="test_table": [c.name for c in r.tables[t].columns]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("ALTER TABLE test_table RENAME COLUMN id TO new_id", ["new_id", "name", "email"]),
        ("ALTER TABLE test_table ADD COLUMN age INT AFTER id, ADD z INT FIRST", ["z", "id", "age", "name", "email"]),
        ("ALTER TABLE test_table CHANGE COLUMN name full_name TEXT FIRST", ["full_name", "id", "email"]),
        ("ALTER TABLE test_table MODIFY email TEXT AFTER id", ["id", "email", "name"]),
        ("ALTER TABLE test_table DROP COLUMN name", ["id", "email"]),
        ("ALTER TABLE test_table ALTER COLUMN name SET DEFAULT 'x'", ["id", "name", "email"]),
    ],
)
def test_fold(text, want):
    after = BASE.apply(text, 123)
    assert names(after) == want and after.tables["test_table"].since == 123 and names(BASE) == ["id", "name", "email"]
    assert all(c.type for c in after.tables["test_table"].columns)


@pytest.mark.parametrize(
    ("text", "message"),
    [("ALTER TABLE no RENAME COLUMN a TO b", "table not found"), ("ALTER TABLE test_table DROP COLUMN no", "column not found"), ("ALTER TABLE test_table ADD name INT", "already exists"), ("ALTER TABLE test_table ADD n INT AFTER no", "column not found")],
)
def test_fold_errors_leave_nothing(text, message):
    with pytest.raises(SchemaError, match=message):
        BASE.apply(text, 1)


def test_tables_and_keys():
    after = BASE.apply("CREATE TABLE copy LIKE test_table; RENAME TABLE test_table TO t2; ALTER TABLE t2 DROP PRIMARY KEY, ADD PRIMARY KEY (email)", 5)
    assert set(after.tables) == {"copy", "t2"} and after.tables["t2"].keys == ["email"] and after.tables["copy"].keys == ["id"]
    assert "t2" not in after.apply("DROP TABLE t2", 6).tables
    assert after.apply("ALTER TABLE t2 RENAME TO t3", 7).tables["t3"].since == 7


def test_types_of_chosen_columns_only():
    table = Registry().apply("CREATE TABLE t (id INT PRIMARY KEY, v VECTOR(3), r REAL)", 1).tables["t"]
    kinds = dict(table.typed(ColumnChoice(excluded=("v",)), ["REAL_AS_FLOAT"]))
    assert kinds["r"].name == "float" and kinds["id"].spark == "int"
    assert dict(table.typed(ColumnChoice(excluded=("v",))))["r"].name == "double"


def test_history():
    history = [{"query": "CREATE TABLE t (a INT)", "unixTs": 1}, {"query": "ALTER TABLE t ADD b INT", "unixTs": 2}]
    assert names(recover(history, 2), "t") == ["a", "b"]
    with pytest.raises(SchemaError):
        recover(history, 1)
    registry, added = bootstrap(recover(history, None), ["t", "u"], lambda n: f"CREATE TABLE {n} (z INT)", 9)
    assert names(registry, "u") == ["z"] and [h["unixTs"] for h in added] == [9]
    assert [v["since"] for v in versions(history)] == [1, 2]
