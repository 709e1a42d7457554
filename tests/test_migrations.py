"""Small source tables of every dialect, from raw rows to checked targets."""

import datetime
import sqlite3
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkload import (
    ColumnSpec, ForeignKeySpec, KeySpec, LoadOptions, TableSpec, cast_table, child_parent_join, compare_tables,
    fk_orphans, load_database, read_sqlite_table, table_counts,
)


def good(spark, rows, schema, columns, dialect):
    out = cast_table(spark.createDataFrame(rows, schema), columns, dialect, on_error="fail")
    return out, [tuple(r) for r in out.collect()]


def test_mysql_basic_types(spark):
    columns = (
        ColumnSpec("id", "int(11)", False, "auto_increment"), ColumnSpec("name", "varchar(100)", False),
        ColumnSpec("description", "text"), ColumnSpec("is_active", "tinyint(1)"), ColumnSpec("price", "decimal(10,2)"),
        ColumnSpec("rating", "float"), ColumnSpec("created_at", "datetime"),
        ColumnSpec("updated_at", "timestamp", extra="on update CURRENT_TIMESTAMP"),
    )
    raw = [
        (1, "Widget A", "A basic widget", 1, Decimal("19.99"), 4.5, "2024-01-15 10:30:00", "0000-00-00 00:00:00"),
        (2, "Widget B", "Another\x00 widget", 0, Decimal("29.99"), 3.8, "2024-01-15 10:30:00.000001", None),
    ]
    schema = "id int, name string, description string, is_active tinyint, price decimal(10,2), rating double, created_at string, updated_at string"
    out, rows = good(spark, raw, schema, columns, "mysql")
    assert [f.dataType for f in out.schema] == [
        T.IntegerType(), T.StringType(), T.StringType(), T.BooleanType(), T.DecimalType(10, 2), T.DoubleType(),
        T.TimestampType(), T.TimestampType(),
    ]
    assert rows[0][3] is True and rows[0][7] is None and rows[0][4] == Decimal("19.99")
    assert rows[1][2] == "Another widget" and rows[1][6].microsecond == 1
    assert out.schema["id"].metadata["auto_increment"] is True


def test_mysql_other_types(spark):
    columns = (
        ColumnSpec("date_col", "date"), ColumnSpec("datetime_col", "datetime"), ColumnSpec("year_col", "year(4)"),
        ColumnSpec("big_unsigned", "bigint(20) unsigned"), ColumnSpec("flag", "bit(1)"), ColumnSpec("flags", "bit(8)"),
        ColumnSpec("mood", "enum('happy','sad')", labels=("happy", "sad")), ColumnSpec("data", "json", False),
        ColumnSpec("t", "time"), ColumnSpec("p", "point"),
    )
    raw = [(
        "2024-01-15", "2025-12-31 23:59:59", 2026, Decimal("18446744073709551615"), bytearray(b"\x01"),
        bytearray(b"\xaa"), "sad", '{"items": [1,2,3], "nested": {"a": 1}}', "10:30:00", "POINT(1 2)",
    )]
    schema = (
        "date_col string, datetime_col string, year_col int, big_unsigned decimal(20,0), flag binary, flags binary, "
        "mood string, data string, t string, p string"
    )
    out, rows = good(spark, raw, schema, columns, "mysql")
    assert rows[0][:7] == (
        datetime.date(2024, 1, 15), datetime.datetime(2025, 12, 31, 23, 59, 59), 2026,
        Decimal("18446744073709551615"), True, "10101010", "sad",
    )
    assert rows[0][8:] == ("10:30:00", "(1,2)")
    assert out.select(F.to_json("data").alias("j")).first().j == '{"items":[1,2,3],"nested":{"a":1}}'


def test_values_as_a_jdbc_driver_gives_them(spark):
    columns = (
        ColumnSpec("y", "year(4)"), ColumnSpec("t", "time"), ColumnSpec("b", "tinyint(1)"), ColumnSpec("f", "bit(1)"),
        ColumnSpec("d", "datetime"),
    )
    stamp = datetime.datetime(1970, 1, 1, 10, 30, 0, 500000)
    raw = [(datetime.date(2024, 1, 1), stamp, True, False, datetime.datetime(2024, 1, 15, 10, 30))]
    _, rows = good(spark, raw, "y date, t timestamp, b boolean, f boolean, d timestamp", columns, "mysql")
    assert rows == [(2024, "10:30:00.500000", True, False, datetime.datetime(2024, 1, 15, 10, 30))]


def test_pgsql_types(spark):
    columns = (
        ColumnSpec("id", "integer"), ColumnSpec("amount", "money", False), ColumnSpec("tags", "text[]"),
        ColumnSpec("data", "jsonb"), ColumnSpec("price", "numeric(10,2)"), ColumnSpec("paid_at", "timestamp with time zone"),
        ColumnSpec("mood", "mood", labels=("sad", "ok", "happy")), ColumnSpec("lsn", "pg_lsn"), ColumnSpec("x", "xid"),
    )
    raw = [("1", "$250.50", '{test,"js on"}', '{"key": "value"}', "49.99", "2024-01-15 10:30:00+00", "ok", "16/B374D848", "7")]
    names = [c.name for c in columns]
    out, rows = good(spark, raw, ", ".join(f"{n} string" for n in names), columns, "pgsql")
    assert rows[0][:3] == (1, Decimal("250.5000"), ["test", "js on"])
    assert rows[0][4:] == (Decimal("49.99"), datetime.datetime(2024, 1, 15, 10, 30), "ok", "16/B374D848", 7)


def test_mssql_types(spark):
    columns = (
        ColumnSpec("id", "int", False, "auto_increment"), ColumnSpec("name", "nvarchar(255)", False), ColumnSpec("salary", "float(53)"),
        ColumnSpec("bio", "varbinary(100)"), ColumnSpec("is_active", "bit"), ColumnSpec("birthday", "date"),
        ColumnSpec("created_at", "datetime2"), ColumnSpec("amount", "numeric(10,2)"), ColumnSpec("guid", "uniqueidentifier"),
    )
    raw = [(
        1, "Alice", 75000.5, bytearray(b"Hello"), True, "1994-03-15", "2024-01-15T10:30:00.1234567", Decimal("99.99"),
        "6F9619FF-8B86-D011-B42D-00C04FC964FF",
    )]
    schema = (
        "id int, name string, salary double, bio binary, is_active boolean, birthday string, created_at string, "
        "amount decimal(10,2), guid string"
    )
    out, rows = good(spark, raw, schema, columns, "mssql")
    assert out.schema["id"].dataType == T.LongType() and out.schema["amount"].dataType == T.DecimalType(10, 2)
    assert bytes(rows[0][3]) == b"Hello" and rows[0][4] is True and rows[0][5] == datetime.date(1994, 3, 15)
    assert rows[0][6] == datetime.datetime(2024, 1, 15, 10, 30, 0, 123456)
    assert rows[0][8] == "6f9619ff-8b86-d011-b42d-00c04fc964ff"


@pytest.fixture
def sqlite_file(tmp_path):
    file = tmp_path / "app.db"
    con = sqlite3.connect(file)
    con.executescript(
        """
        CREATE TABLE basic_types (id INTEGER PRIMARY KEY AUTOINCREMENT, name TEXT NOT NULL, age INTEGER, salary REAL,
                                  bio BLOB, is_active INTEGER, birthday TEXT, created_at DATETIME);
        INSERT INTO basic_types (name, age, salary, bio, is_active, birthday, created_at) VALUES
          ('Alice', 30, 75000.50, x'48656c6c6f', 1, '1994-03-15', '2024-01-15 10:30:00'),
          ('Bob', 25, 65000.00, NULL, 0, '1999-07-22', '2024-01-15 10:30:00.25');
        CREATE TABLE parent (id INTEGER PRIMARY KEY, name TEXT NOT NULL);
        CREATE TABLE child (id INTEGER PRIMARY KEY, parent_id INTEGER, note VARCHAR(255));
        INSERT INTO parent VALUES (1, 'p1'), (2, 'p2');
        INSERT INTO child VALUES (10, 1, 'a'), (11, 2, 'b');
        """
    )
    con.close()
    return str(file)


SQLITE_TABLES = (
    TableSpec(
        "basic_types",
        (
            ColumnSpec("id", "INTEGER", False, "auto_increment"), ColumnSpec("name", "TEXT", False), ColumnSpec("age", "INTEGER"),
            ColumnSpec("salary", "REAL"), ColumnSpec("bio", "BLOB"), ColumnSpec("is_active", "INTEGER"),
            ColumnSpec("birthday", "TEXT"), ColumnSpec("created_at", "DATETIME"),
        ),
        keys=(KeySpec(("id",), primary=True),),
    ),
    TableSpec("parent", (ColumnSpec("id", "INTEGER", False), ColumnSpec("name", "TEXT", False)), keys=(KeySpec(("id",), True),)),
    TableSpec(
        "child",
        (ColumnSpec("id", "INTEGER", False), ColumnSpec("parent_id", "INTEGER"), ColumnSpec("note", "VARCHAR(255)")),
        keys=(KeySpec(("id",), True),),
        foreign_keys=(ForeignKeySpec(("parent_id",), "parent", ("id",), on_delete="cascade"),),
    ),
)


def test_sqlite_migration_and_its_verification(spark, sqlite_file, tmp_path):
    report = load_database(
        spark, SQLITE_TABLES, lambda spec: read_sqlite_table(spark, sqlite_file, spec, 2), "sqlite", str(tmp_path / "lake"),
        LoadOptions(),
    )
    tables = {name: t.good for name, t in report.tables.items()}
    assert {r.table: r.n_rows for r in table_counts(tables).collect()} == {"basic_types": 2, "parent": 2, "child": 2}
    alice = tables["basic_types"].filter("name = 'Alice'").first()
    assert (alice.age, alice.salary, bytes(alice.bio), alice.is_active) == (30, 75000.5, b"Hello", 1)
    assert tables["basic_types"].filter("name = 'Bob'").first().created_at.microsecond == 250000
    parent = tables["parent"].withColumnsRenamed({"id": "p_id", "name": "p_name"})
    fk = ForeignKeySpec(("parent_id",), "parent", ("p_id",))
    joined = child_parent_join(tables["child"], parent, fk)
    assert {(r.note, r.p_name) for r in joined.collect()} == {("a", "p1"), ("b", "p2")}
    assert fk_orphans(tables["child"], parent, fk).count() == 0
    assert [r.next_value for r in report.tables["basic_types"].sequences.collect()] == [3]
    again = cast_table(read_sqlite_table(spark, sqlite_file, SQLITE_TABLES[2]), SQLITE_TABLES[2].columns, "sqlite", on_error="fail")
    agreed = compare_tables(again, tables["child"], ["id"], "child").first()
    assert (agreed.missing, agreed.extra, agreed.changed) == (0, 0, 0)


def test_one_failing_table_stops_the_run(spark, tmp_path):
    seen = []

    def source(spec):
        seen.append(spec.name)
        raise OSError("source gone")

    with pytest.raises(OSError):
        load_database(spark, SQLITE_TABLES, source, "sqlite", str(tmp_path))
    assert seen == ["basic_types"]
