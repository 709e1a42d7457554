import sqlite3

import pytest
from pyspark.sql import types as T

from sparkload.model import ColumnSpec, ForeignKeySpec, KeySpec, TableSpec
from sparkload.operators.casting import cast_table
from sparkload.operators.sharding import balanced_ranges, measure_ranges, pk_ranges, shard_by_pk, shard_predicates
from sparkload.sources import jdbc
from sparkload.sources.sqlite import list_sqlite_tables, read_sqlite_table
from sparkload.sources.tables import list_tables, materialize_views, select_tables, table_pattern


# --- shards --------------------------------------------------------------------------


@pytest.mark.parametrize("low,high,n", [(1, 100, 8), (0, 7, 8), (1, 3, 8), (-5, 5, 3), (7, 7, 4), (1, 101, 4)])
def test_ranges_cover_every_key_once(spark, low, high, n):
    ranges = pk_ranges(low, high, n)
    assert len(ranges) == n and ranges[-1][1] == high + 1
    for key in range(low, high + 1):
        assert sum(lo <= key < hi for lo, hi in ranges) == 1


@pytest.mark.parametrize(
    "keys",
    [list(range(1000)), [*range(1000), 10**15], [-(10**15), *range(500), *range(10**9, 10**9 + 500)], [7] * 50, [1, 2]],
)
def test_balanced_ranges_cover_every_key_and_spread_the_rows(keys):
    def measure(ranges):
        inside = {i: [k for k in keys if lo <= k < hi] for i, (lo, hi) in enumerate(ranges)}
        return {i: (len(ks), min(ks), max(ks)) for i, ks in inside.items() if ks}

    ranges = balanced_ranges(min(keys), max(keys), 8, measure)
    assert ranges[0][0] == min(keys) and ranges[-1][1] > max(keys)
    assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:])) and all(lo < hi for lo, hi in ranges)
    assert len(balanced_ranges(min(keys), max(keys), 100, measure)) < 500
    if len(set(keys)) > 100:
        assert max(n for n, _, _ in measure(ranges).values()) <= 2 * len(keys) / 8
    assert len(ranges) <= 40
    assert balanced_ranges(None, None, 8, measure) == []


def test_balanced_ranges_of_a_frame(spark):
    df = spark.range(1000).unionByName(spark.createDataFrame([(10**15,)], "id bigint"))
    ranges = balanced_ranges(0, 10**15, 8, measure_ranges(df, "id"))
    counts = measure_ranges(df, "id")(ranges)
    assert sum(n for n, _, _ in counts.values()) == 1001 and max(n for n, _, _ in counts.values()) <= 251


def test_no_ranges_for_empty_tables_or_one_shard():
    assert pk_ranges(None, None, 8) == [] and pk_ranges(1, 10, 1) == []


def test_shard_ids_agree_with_the_ranges(spark):
    df = spark.range(-3, 1000, 7).withColumnRenamed("id", "k")
    got = shard_by_pk(df, "k", 8).collect()
    low, high = -3, max(r.k for r in got)
    ranges = pk_ranges(low, high, 8)
    assert all(ranges[r.shard_id][0] <= r.k < ranges[r.shard_id][1] for r in got)


def test_shards_over_the_whole_64_bit_range(spark):
    keys = [-(2**63), -1, 0, 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    ranges = pk_ranges(min(keys), max(keys), 4)
    got = shard_by_pk(df, "k", 4).collect()
    assert all(ranges[r.shard_id][0] <= r.k < ranges[r.shard_id][1] for r in got)


def test_text_key_is_one_shard(spark):
    assert shard_by_pk(spark.createDataFrame([("a",)], "k string"), "k", 4).first().shard_id == 0


def test_predicates_split_a_table(spark):
    df = spark.range(1, 104).withColumnRenamed("id", "k")
    counts = [df.filter(p).count() for p in shard_predicates("`k`", 1, 103, 4)]
    assert sum(counts) == 103 and len(counts) == 4
    assert len(shard_predicates("`k`", 1, 3, 8)) < 8


# --- JDBC statements (no database is started here) -----------------------------------

SPEC = TableSpec(
    "t x",
    (ColumnSpec("id", "int(11)"), ColumnSpec("g", "geometry"), ColumnSpec("when", "datetime2")),
    schema="dbo",
    keys=(KeySpec(("id",), primary=True),),
)


def test_mysql_statement():
    assert jdbc.select_statement(SPEC, "mysql", "id > 3") == (
        "SELECT `id`, ST_AsText(`g`) AS `g`, `when` FROM `dbo`.`t x` WHERE id > 3"
    )
    assert jdbc.bounds_statement(SPEC, "mysql", "id") == "SELECT MIN(`id`) AS lo, MAX(`id`) AS hi FROM `dbo`.`t x`"


@pytest.mark.parametrize(
    "kind,want",
    [("time", "convert(varchar(30), [c], 114) AS [c]"), ("datetime", "convert(varchar(30), [c], 126) AS [c]"),
     ("date", "convert(varchar(30), [c], 126) AS [c]"), ("datetimeoffset", "convert(varchar(35), [c], 127) AS [c]"),
     ("uniqueidentifier", "convert(varchar(36), [c]) AS [c]"), ("int", "[c]")],
)
def test_mssql_expressions(kind, want):
    assert jdbc.column_expression(ColumnSpec("c", kind), "mssql") == want


def test_pgsql_expressions_and_quoting():
    assert jdbc.column_expression(ColumnSpec("m", "money"), "pgsql") == '"m"::numeric AS "m"'
    assert jdbc.quote_identifier('a"b', "pgsql") == '"a""b"'
    assert jdbc.quote_identifier("a]b", "mssql") == "[a]]b]"


def test_shard_key_needs_a_whole_number():
    assert jdbc.shard_key(SPEC, "mysql") == "id"
    text_key = TableSpec("t", (ColumnSpec("id", "varchar(9)"),), keys=(KeySpec(("id",), primary=True),))
    assert jdbc.shard_key(text_key, "mysql") is None
    assert jdbc.shard_key(TableSpec("t", (ColumnSpec("id", "int"),)), "mysql") is None


class Recorder:
    """Stands in for a session: records what would be sent and answers the bounds query."""

    def __init__(self, bounds):
        self.read, self.bounds, self.calls = self, bounds, []

    def jdbc(self, url, table, predicates=None, properties=None):
        self.calls.append((table, predicates, properties))
        return self

    def first(self):
        return self.bounds

    def collect(self):
        return [(0, 900, 1, 20), (3, 10, 90, 100)]


def test_sharded_scan_sends_one_query_per_range():
    spark = Recorder((1, 100))
    jdbc.read_jdbc_table(spark, "jdbc:x", SPEC, "mysql", shards=4, properties={"user": "u"})
    bounds, scan = spark.calls
    assert bounds[0] == "(SELECT MIN(`id`) AS lo, MAX(`id`) AS hi FROM `dbo`.`t x`) b"
    assert scan[0] == "(SELECT `id`, ST_AsText(`g`) AS `g`, `when` FROM `dbo`.`t x`) t"
    assert scan[1] == [
        "`id` >= 1 AND `id` < 25", "`id` >= 25 AND `id` < 49", "`id` >= 49 AND `id` < 73", "`id` >= 73 AND `id` < 101"
    ]
    assert scan[2] == {"fetchsize": "10000", "user": "u"}


def test_balanced_scan_splits_crowded_ranges():
    spark = Recorder((1, 100))
    jdbc.read_jdbc_table(spark, "jdbc:x", SPEC, "mysql", shards=4, balanced=True)
    counted = spark.calls[1][0]
    assert counted.startswith(
        "(SELECT r, COUNT(*) AS n, MIN(k) AS lo, MAX(k) AS hi FROM (SELECT CASE WHEN `id` >= 1 AND `id` < 25 THEN 0 "
    )
    predicates = spark.calls[-1][1]
    # Rows were found at keys 1 to 20 and 90 to 100 only, most of them in the first range.
    assert predicates[0].startswith("`id` >= 1 AND `id` < ") and predicates[-1].endswith("`id` < 101")
    assert len(predicates) >= 4 and int(predicates[0].split()[-1]) < 20


def test_scan_in_one_partition():
    empty = Recorder((None, None))
    jdbc.read_jdbc_table(empty, "jdbc:x", SPEC, "mysql", shards=4)
    assert [c[1] for c in empty.calls] == [None, None]
    no_key = Recorder((1, 9))
    jdbc.read_jdbc_table(no_key, "jdbc:x", TableSpec("t", SPEC.columns), "pgsql", shards=4, where="id > 3")
    assert no_key.calls == [('(SELECT "id", "g", "when" FROM "t" WHERE id > 3) t', None, {"fetchsize": "10000"})]
    one = Recorder((1, 9))
    jdbc.read_jdbc_table(one, "jdbc:x", SPEC, "mysql")
    assert len(one.calls) == 1


def test_mssql_names_go_to_lower_case(spark):
    df = spark.createDataFrame([(1,)], "Id int")
    assert jdbc.normalize_names(df, "mssql").columns == ["id"]
    assert jdbc.normalize_names(df, "mysql").columns == ["Id"]
    spec = TableSpec(
        "T", (ColumnSpec("Id", "int"), ColumnSpec("Pid", "int")), keys=(KeySpec(("Id",), True),),
        foreign_keys=(ForeignKeySpec(("Pid",), "P", ("Id",)),),
    )
    low = jdbc.normalize_spec(spec, "mssql")
    assert (low.column_names, low.primary_key, low.foreign_keys[0].columns) == (["id", "pid"], ("id",), ("pid",))
    assert low.foreign_keys[0].parent_columns == ("id",) and jdbc.normalize_spec(spec, "mysql") == spec


# --- SQLite --------------------------------------------------------------------------


@pytest.fixture
def sqlite_file(tmp_path):
    file = tmp_path / "src" / "a.db"
    file.parent.mkdir()
    con = sqlite3.connect(file)
    con.executescript(
        """
        CREATE TABLE basic (id integer primary key autoincrement, name VARCHAR(255), salary real, bio blob,
                            amount NUMERIC, born date);
        CREATE TABLE "Test""Tbl" (id integer primary key, val text);
        CREATE TABLE norow (k text primary key, v int) WITHOUT ROWID;
        CREATE VIEW v AS SELECT 1;
        INSERT INTO "Test""Tbl" VALUES (1, 'x');
        INSERT INTO norow VALUES ('a', 1), ('b', 2);
        """
    )
    con.executemany(
        "INSERT INTO basic (name, salary, bio, amount, born) VALUES (?, ?, ?, ?, ?)",
        [(f"n{i}", i + 0.5, bytes([255, i % 256]), i, "2024-01-15") for i in range(1000)],
    )
    con.execute("INSERT INTO basic (id, name, salary) VALUES (5000, 'text in real', 'oops')")
    con.commit()
    con.close()
    return str(file)


BASIC = TableSpec(
    "basic",
    (ColumnSpec("id", "integer", extra="auto_increment"), ColumnSpec("name", "VARCHAR(255)"),
     ColumnSpec("salary", "real"), ColumnSpec("bio", "blob"), ColumnSpec("amount", "NUMERIC"), ColumnSpec("born", "date")),
)


@pytest.mark.parametrize("shards", [1, 4])
def test_sqlite_scan(spark, sqlite_file, shards):
    raw = read_sqlite_table(spark, sqlite_file, BASIC, shards)
    assert raw.rdd.getNumPartitions() == shards
    out = cast_table(raw, BASIC.columns, "sqlite")
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 1001
    assert bytes(rows[6].bio) == b"\xff\x05" and rows[6].salary == 5.5 and rows[6].name == "n5"
    assert out.schema["amount"].dataType == T.DecimalType(38, 10)
    assert rows[5000]._errors[0].column == "salary" and rows[6]._errors is None


def test_sqlite_quoted_names_and_tables_without_rowid(spark, sqlite_file):
    odd = TableSpec('Test"Tbl', (ColumnSpec("id", "integer"), ColumnSpec("val", "text")))
    assert [tuple(r) for r in read_sqlite_table(spark, sqlite_file, odd, 3).collect()] == [("1", "x")]
    norow = TableSpec("norow", (ColumnSpec("k", "text"), ColumnSpec("v", "int")))
    assert read_sqlite_table(spark, sqlite_file, norow, 3).count() == 2


def test_sqlite_many_files(spark, sqlite_file):
    import os
    import shutil

    folder = os.path.dirname(sqlite_file)
    shutil.copy(sqlite_file, os.path.join(folder, "b.db"))
    assert read_sqlite_table(spark, folder, BASIC, 2).count() == 2002
    with pytest.raises(FileNotFoundError):
        read_sqlite_table(spark, os.path.join(folder, "none*.x"), BASIC)


def test_sqlite_table_list(spark, sqlite_file):
    assert [r.table_name for r in list_sqlite_tables(spark, sqlite_file).collect()] == ['Test"Tbl', "basic", "norow"]


# --- table selection -----------------------------------------------------------------


@pytest.mark.parametrize(
    "pattern,yes,no",
    [("~/actor/", ["actor", "actor_history", "ACTOR"], ["act"]), ("~/^actor$/", ["actor"], ["actor_history"]),
     ("'customer'", ["customer", "Customer"], ["customer_addr"]), ("payment", ["payment"], ["payments"]),
     ("'test_%'", ["test_1", "test_abc"], ["not_match", "tes"]), ("a.b", ["a.b"], ["axb"])],
)
def test_table_patterns(spark, pattern, yes, no):
    names = spark.createDataFrame([(n,) for n in yes + no], "table_name string")
    assert sorted(r.table_name for r in select_tables(names, [pattern]).collect()) == sorted(yes)


def test_include_then_exclude(spark):
    names = spark.createDataFrame([(n,) for n in ("film", "film_text", "customer", "payment")], "table_name string")
    assert [r.table_name for r in select_tables(names).collect()] == ["customer", "film", "film_text", "payment"]
    got = select_tables(names, ["~/film/", "'customer'"], ["'film_%'"]).collect()
    assert [r.table_name for r in got] == ["customer", "film"]


def test_bad_pattern():
    with pytest.raises(ValueError):
        table_pattern("~/[invalid/")


def test_list_tables_and_materialize_views(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS mv")
    spark.range(5).write.mode("overwrite").saveAsTable("mv.base")
    spark.sql("CREATE OR REPLACE VIEW mv.even AS SELECT id FROM mv.base WHERE id % 2 = 0")
    assert [tuple(r) for r in list_tables(spark, "mv").collect()] == [("mv", "base")]
    stored = materialize_views(spark, ["mv.even"], str(tmp_path))
    assert sorted(r.id for r in stored["mv.even"].collect()) == [0, 2, 4]
    spark.sql("CREATE DATABASE IF NOT EXISTS mv_target")
    tables = materialize_views(spark, "mv.even", "mv_target", as_tables=True)
    assert tables["mv.even"].count() == 3 and [r.table_name for r in list_tables(spark, "mv_target").collect()] == ["even"]
    spark.range(3).createOrReplaceTempView("tmp_view")
    assert "tmp_view" in materialize_views(spark, "*", str(tmp_path / "all"))


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_sqlite_shards_with_own_rowid_column_and_largest_identifier(spark, tmp_path, shards):
    file = str(tmp_path / "own.db")
    con = sqlite3.connect(file)
    con.execute("CREATE TABLE t (rowid integer, v)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(k if k % 3 else None, f"v{k}") for k in range(30)])
    con.execute("INSERT INTO t (_rowid_, rowid, v) VALUES (9223372036854775807, NULL, 'last')")
    con.commit()
    con.close()
    spec = TableSpec("t", (ColumnSpec("rowid", "integer"), ColumnSpec("v", "")))
    got = sorted(r.v for r in read_sqlite_table(spark, file, spec, shards).collect())
    assert got == sorted([*[f"v{k}" for k in range(30)], "last"])


def test_sqlite_table_list_of_all_files(spark, tmp_path):
    for name, table in (("a.db", "one"), ("b.db", "two"), ("c.db", "one")):
        con = sqlite3.connect(str(tmp_path / name))
        con.execute(f"CREATE TABLE {table} (x)")
        con.close()
    assert [r.table_name for r in list_sqlite_tables(spark, str(tmp_path)).collect()] == ["one", "two"]


def test_views_of_one_name_do_not_overwrite_each_other(spark, tmp_path):
    for schema, n in (("da", 2), ("db", 3)):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.v AS SELECT id FROM range({n})")
    stored = materialize_views(spark, ["da.v", "db.v"], str(tmp_path))
    assert stored["da.v"].count() == 2 and stored["db.v"].count() == 3


# --- filters and key ranges in SQLite statements -------------------------------------


def _sqlite_rows(path):
    con = sqlite3.connect(path)
    con.executescript(
        """
        CREATE TABLE keyed (id INT, name TEXT COLLATE NOCASE, price REAL, any, note BLOB, PRIMARY KEY (id, name)) WITHOUT ROWID;
        """
    )
    con.executemany("INSERT INTO keyed VALUES (?, ?, ?, ?, ?)", [(i, f"N{i % 10}", i / 4, i if i % 2 else str(i), None if i % 3 else b"x") for i in range(0, 3000, 3)])
    con.execute("INSERT INTO keyed VALUES (4000.5, 'n1', 'inf', 5, NULL), (4001, CAST(x'6E35' AS BLOB), 1e999, '5', NULL)")
    con.commit()
    con.close()
    return path


KEYED = TableSpec("keyed", (ColumnSpec("id", "int"), ColumnSpec("name", "text"), ColumnSpec("price", "real"), ColumnSpec("any", "text"), ColumnSpec("note", "blob")))


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_filters_in_statements_change_nothing(spark, tmp_path, shards):
    raw = read_sqlite_table(spark, _sqlite_rows(str(tmp_path / "k.db")), KEYED, shards)
    rows = [r.asDict() for r in raw.collect()]
    assert len(rows) == 1002
    tests = [
        ("name = 'N5'", lambda r: r["name"] == "N5"), ("name = 'n5'", lambda r: r["name"] == "n5"), ("name >= 'N7'", lambda r: r["name"] >= "N7"),
        ("price = '1.5'", lambda r: r["price"] == "1.5"), ("price = 'inf'", lambda r: r["price"] == "inf"), ("id = '06'", lambda r: r["id"] == "06"),
        ("id IN ('6', '9', '4000.5')", lambda r: r["id"] in ("6", "9", "4000.5")), ("any = '5'", lambda r: r["any"] == "5"), ("id < '12'", lambda r: r["id"] < "12"),
        ("note IS NULL AND name LIKE 'n%'", lambda r: r["note"] is None and r["name"].startswith("n")), ("name <=> 'N3'", lambda r: r["name"] == "N3"),
    ]
    for condition, holds in tests:
        got = sorted(r.id for r in raw.filter(condition).collect())
        assert got == sorted(r["id"] for r in rows if holds(r)), condition


def test_statements_hold_ranges_and_filters(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    from sparkload.sources.sqlite import RowidRange, SqliteReader, open_read_only, raw_schema

    file = _sqlite_rows(str(tmp_path / "k.db"))
    con = sqlite3.connect(file)
    con.execute("DELETE FROM keyed WHERE id > 3500")
    con.commit()
    con.close()
    reader = SqliteReader(raw_schema(KEYED), {"files": f'["{file}"]', "table": "keyed", "shards": "3"})
    filters = [EqualTo(("name",), "N5"), In(("id",), ("6", "9")), GreaterThan(("price",), "3"), EqualTo(("note",), b"x")]
    assert list(reader.pushFilters(filters)) == filters  # Spark evaluates them all again
    connection = open_read_only(file)
    made = [reader.statement(connection, RowidRange(file, k, 3)) for k in range(3)]
    assert [m[1][:2] for m in made] == [[0, 1000], [1000, 1999], [1999, 2997]] or all('"id" >= ?' in m[0] for m in made)
    assert all('"name" = ?' in m[0] and '"id" IN (?, ?)' in m[0] and '"price"' not in m[0].split("WHERE")[1] for m in made)
    plan = " ".join(r[3] for r in connection.execute("EXPLAIN QUERY PLAN " + made[1][0], made[1][1]))
    assert "PRIMARY KEY (id>? AND id<?)" in plan
    connection.close()
