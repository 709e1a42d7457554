import datetime
import re

import pytest
from pyspark.sql import functions as F

from sparkload import sinks
from sparkload.load import (
    LoadOptions, LoadReport, format_bytes, format_report, format_seconds, load_database, load_report, load_table,
    publish_table, read_loaded,
)
from sparkload.functions.copytext import encode_row, row_bytes
from sparkload.model import ColumnSpec, ForeignKeySpec, KeySpec, PartitionSpec, TableSpec
from sparkload.operators.casting import cast_table
from sparkload.operators.partitioning import route_partition, unrouted_rows
from sparkload.session import scratch_dir, session_conf

PARENT = TableSpec(
    "parent", (ColumnSpec("id", "int(11)", False, "auto_increment"), ColumnSpec("name", "varchar(5)")), "app",
    keys=(KeySpec(("id",), primary=True),),
)
CHILD = TableSpec(
    "child", (ColumnSpec("id", "int(11)", False), ColumnSpec("pid", "int(11)"), ColumnSpec("born", "date")), "app",
    keys=(KeySpec(("id",), primary=True),), foreign_keys=(ForeignKeySpec(("pid",), "app.parent", ("id",)),),
)


@pytest.fixture
def raw(spark):
    return {
        "app.parent": spark.createDataFrame([("1", "ann"), ("2", "toolong"), ("7", "bob")], "id string, name string"),
        "app.child": spark.createDataFrame(
            [("1", "1", "2024-01-15"), ("2", "2", "0000-00-00"), ("3", None, "x"), ("1", "7", None)],
            "id string, pid string, born string",
        ),
    }


def run(spark, raw, target, **options):
    return load_database(
        spark, [PARENT, CHILD], lambda s: raw[s.qualified_name], "mysql", str(target), LoadOptions(**options)
    )


def test_load_database(spark, raw, tmp_path):
    report = run(spark, raw, tmp_path)
    parent, child = report.tables["app.parent"], report.tables["app.child"]
    assert (parent.rows, parent.errors, child.rows, child.errors) == (2, 1, 3, 1)
    assert parent.bytes == len("1\tann\n7\tbob\n")
    assert [tuple(r) for r in child.rejects.collect()] == [("app.child", '{"id":"3"}', "born", "x", "not a valid date")]
    checks = {(r.check, r.columns): (r.n_keys, r.n_rows) for r in child.checks.collect()}
    assert checks == {("primary key", "id"): (1, 2), ("foreign key", "pid"): (1, 1), ("not null", "id"): (0, 0)}
    assert [tuple(r) for r in parent.sequences.collect()] == [("id", 7, 8)]
    assert child.good.filter("born is null").count() == 2
    table = load_report(spark, report)
    assert [tuple(r)[:4] for r in table.orderBy("table").collect()] == [
        ("app.child", 1, 3, child.bytes), ("app.parent", 1, 2, parent.bytes)
    ]
    text = format_report(report)
    assert re.search(r"Total import time\s+2\s+5\s+\d+ B\s+\d+\.\d{3}s$", text)
    assert "app.parent" in text and "copy" in text


def test_options(spark, raw, tmp_path):
    uncounted = run(spark, raw, tmp_path / "e", count_bytes=False).tables["app.parent"]
    assert (uncounted.rows, uncounted.bytes) == (2, 0)
    empty = run(spark, raw, tmp_path / "a", schema_only=True)
    assert [t.rows for t in empty.tables.values()] == [0, 0] and empty.tables["app.child"].good.count() == 0
    data = run(spark, raw, tmp_path / "b", data_only=True)
    assert data.tables["app.child"].checks is None
    no_fk = run(spark, raw, tmp_path / "c", foreign_keys=False, reset_sequences=False)
    assert {r.check for r in no_fk.tables["app.child"].checks.collect()} == {"primary key", "not null"}
    assert no_fk.tables["app.parent"].sequences is None
    with pytest.raises(Exception, match="app.parent"):
        run(spark, raw, tmp_path / "d", on_error="stop")


def test_load_modes(spark, raw, tmp_path):
    run(spark, raw, tmp_path, mode="create")
    with pytest.raises(Exception):
        run(spark, raw, tmp_path, mode="create")
    again = run(spark, raw, tmp_path, mode="append").tables["app.child"]
    assert again.rows == 3 and again.good.count() == 6 and again.rejects.count() == 1
    emptied = run(spark, raw, tmp_path, mode="truncate").tables["app.child"]
    assert emptied.good.count() == 3
    raw["app.child"] = raw["app.child"].limit(0)
    assert run(spark, raw, tmp_path).tables["app.child"].good.count() == 0


def test_publish_to_the_catalog(spark, raw, tmp_path):
    from dataclasses import replace

    spec = replace(PARENT, comment="people", columns=(replace(PARENT.columns[0], comment="the key"), PARENT.columns[1]))
    loaded = load_table(raw["app.parent"], spec, "mysql", str(tmp_path))
    publish_table(loaded, "published_parent", "drop_create")
    assert spark.table("published_parent").count() == 2
    described = {r.col_name: r for r in spark.sql("DESCRIBE TABLE EXTENDED published_parent").collect()}
    assert described["Comment"].data_type == "people" and described["id"].comment == "the key"


def test_variants_go_to_a_database_as_text(spark):
    df = spark.sql("SELECT 1 AS id, parse_json('{\"k\": 1}') AS j")
    assert [tuple(r) for r in sinks.jdbc_ready(df).collect()] == [(1, '{"k":1}')]


def test_loading_needs_no_shuffle_and_no_sort(spark, raw, tmp_path):
    loaded = load_table(raw["app.parent"], PARENT, "mysql", str(tmp_path))
    assert loaded.rows == 2 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_partitioned_load(spark, tmp_path):
    spec = TableSpec(
        "logs", (ColumnSpec("id", "int(11)"), ColumnSpec("day", "date")),
        partitioning=PartitionSpec(
            "range", "day",
            (("y23", datetime.date(2023, 1, 1), datetime.date(2024, 1, 1)), ("y24", datetime.date(2024, 1, 1), None)),
        ),
    )
    df = spark.createDataFrame(
        [("1", "2023-05-01"), ("2", "2024-01-01"), ("3", "2020-01-01"), ("x", "2024-02-02")], "id string, day string"
    )
    loaded = load_table(df, spec, "mysql", str(tmp_path))
    assert (loaded.rows, loaded.errors) == (2, 2)
    assert sorted(r.id for r in loaded.good.collect()) == [1, 2]
    assert sorted(r.reason for r in loaded.rejects.collect()) == ["no partition for the row", "not a valid integer"]
    assert (tmp_path / "logs" / "load_outcome=good" / "partition_name=y24").is_dir()


def test_report_formats():
    assert [format_bytes(n) for n in (57, 1024, 1434, 2 * 1024 * 1024)] == ["57 B", "1.0 kB", "1.4 kB", "2.0 MB"]
    assert format_seconds(0.0404) == "0.040s"
    assert format_report(LoadReport()).splitlines()[-1].split() == ["Total", "import", "time", "0", "0", "0", "B", "0.000s"]


# --- partition routing ---------------------------------------------------------------


def routed(spark, spec, values, kind="int"):
    df = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    return [r.partition_name for r in route_partition(df, spec).collect()]


def test_range_routing(spark):
    spec = PartitionSpec("range", "k", tuple((f"p{i}", i * 10, i * 10 + 10) for i in range(9)) + (("low", None, 0),))
    assert routed(spark, spec, [-1, 0, 9, 10, 89, 90, None]) == ["low", "p0", "p0", "p1", "p8", None, None]
    gap = PartitionSpec("range", "k", (("a", 0, 10), ("b", 20, 30)), default="rest")
    assert routed(spark, gap, [5, 15, 25, 30, None]) == ["a", "rest", "b", "rest", "rest"]
    with pytest.raises(ValueError):
        routed(spark, PartitionSpec("range", "k", (("a", 0, 10), ("b", 5, 20))), [1])


def test_list_and_hash_routing(spark):
    spec = PartitionSpec("list", "upper(k)", (("ab", ("A", "B")), ("none", (None, "N"))))
    assert routed(spark, spec, ["a", "B", "n", None, "z"], "string") == ["ab", "ab", "none", "none", None]
    names = set(routed(spark, PartitionSpec("hash", "k", modulus=4), range(100)))
    assert names == {"p0", "p1", "p2", "p3"}
    with pytest.raises(ValueError):
        routed(spark, PartitionSpec("list", "k", (("a", (1,)), ("b", (1,)))), [1])
    with pytest.raises(ValueError):
        routed(spark, PartitionSpec("tree", "k"), [1])


def test_write_partitioned(spark, tmp_path):
    spec = PartitionSpec("list", "k", (("even", (0, 2)), ("odd", (1,))))
    df = spark.range(1000).select("id", (F.col("id") % 4).alias("k"))
    left = sinks.write_partitioned(df, spec, str(tmp_path / "t"))
    assert left.count() == 250 and unrouted_rows(df, spec).count() == 250
    back = spark.read.parquet(str(tmp_path / "t"))
    assert {r.partition_name: r["count"] for r in back.groupBy("partition_name").count().collect()} == {"even": 500, "odd": 250}
    assert back.filter("partition_name = 'odd'").select("k").distinct().collect()[0].k == 1


# --- load modes ----------------------------------------------------------------------


@pytest.mark.parametrize("fmt", ["parquet", "table"])
def test_write_modes(spark, tmp_path, fmt):
    target = str(tmp_path / "t") if fmt == "parquet" else "modes_t"
    read = (lambda: spark.read.parquet(target)) if fmt == "parquet" else (lambda: spark.table(target))
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.write_table(df, target, "drop_create", fmt)
    with pytest.raises(Exception):
        sinks.write_table(df, target, "create", fmt)
    sinks.write_table(df, target, "append", fmt)
    assert read().count() == 2
    sinks.write_table(df.select("v", F.col("id").cast("bigint").alias("id")), target, "truncate", fmt)
    assert read().count() == 1 and dict(read().dtypes) == {"id": "int", "v": "string"}
    sinks.write_table(df.withColumn("w", F.lit(1)), target, "drop_create", fmt)
    assert read().columns == ["id", "v", "w"]
    sinks.write_table(df, target, "drop_create", fmt, schema_only=True)
    assert read().count() == 0 and read().columns == ["id", "v"]
    with pytest.raises(ValueError):
        sinks.write_table(df, target, "replace", fmt)


# --- session -------------------------------------------------------------------------


def test_scratch_folder_is_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(root) and scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_session_conf_is_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session_conf(spark, spark__sql__shuffle__partitions="3", spark__sparkload__test="1"):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before and spark.conf.get("spark.sparkload.test", None) is None


def test_schema_first_then_data(spark, raw, tmp_path):
    frame, target = raw["app.parent"], str(tmp_path)
    assert load_table(frame, PARENT, "mysql", target, LoadOptions(schema_only=True)).good.count() == 0
    loaded = load_table(frame, PARENT, "mysql", target, LoadOptions(mode="truncate"))
    assert loaded.rows == 2 and loaded.good.count() == 2 and loaded.rejects.count() == 1
    more = load_table(frame, PARENT, "mysql", target, LoadOptions(mode="append"))
    assert (more.rows, more.errors, more.good.count(), more.rejects.count()) == (2, 1, 4, 1)


def test_reference_outside_the_run_is_reported(spark, raw, tmp_path):
    report = load_database(spark, [CHILD], lambda s: raw[s.qualified_name], "mysql", str(tmp_path), LoadOptions())
    checks = {r.check: r.n_rows for r in report.tables["app.child"].checks.collect()}
    assert checks["foreign key, app.parent not loaded"] is None and "foreign key" not in checks


def test_source_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "by_day")
    spark.createDataFrame([("1", "a", 1), ("2", "b", 2)], "id string, name string, day int").write.partitionBy("day").parquet(path)
    checked = cast_table(spark.read.parquet(path), PARENT.columns, "mysql", keep=("day",), where="day = 2")
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan) and [r.id for r in checked.collect()] == [2]
    loaded = load_table(spark.read.parquet(path), PARENT, "mysql", str(tmp_path / "out"), LoadOptions(where="day = 1"))
    assert [r.name for r in loaded.good.collect()] == ["a"]


def test_dates_with_trailing_text_and_unlisted_types(spark):
    columns = (ColumnSpec("d", "date"), ColumnSpec("t", "datetime"), ColumnSpec("x", "sql_variant"), ColumnSpec("y", ""))
    good = ["2024-01-01", " 2024-1-2 ", "2024-01-01 10:20", "2024-01-01T10:20:30.5", "2024-01-01 10:20:30+02:00", "2024-01-01 10:20:30Z"]
    bad = ["2024-01-01 garbage", "2024-01-01Tfoo", "2024-01-01 25:00:00", "2024-01-01 10:61", "2024-01-011", "2024-13-01"]
    raw = spark.createDataFrame([(v, v, "any", "thing") for v in good + bad], "d string, t string, x string, y string")
    out = cast_table(raw, columns, "mssql")
    assert out.filter("_errors IS NULL").count() == len(good) and out.filter("size(_errors) = 2").count() == len(bad)
    assert dict(out.dtypes)["x"] == dict(out.dtypes)["y"] == "string" and out.schema["x"].metadata["target_type"] == "sql_variant"
    with pytest.raises(ValueError, match="sql_variant"):
        cast_table(raw, columns, "mssql", refuse_unlisted=True)


def test_byte_counts_equal_the_encoding(spark):
    rows = [("a\tb\\c\nd\r\x08\x0b\x0c é", b"\x00ab", True, 5, None), (None, None, None, None, "x"), ("", b"", False, -7, "\\N")]
    df = spark.createDataFrame(rows, "a string, b binary, c boolean, d int, e string")
    got = df.select(row_bytes(df.schema).alias("n"), F.octet_length(encode_row(df.schema)).alias("m")).collect()
    assert all(r.n == r.m + 1 for r in got)


# --- versions and one scan for all checks --------------------------------------------


VERSIONED = TableSpec(
    "v",
    (ColumnSpec("id", "int", nullable=False), ColumnSpec("kind", "enum('a','b')", labels=("a", "b")), ColumnSpec("ref", "int")),
    keys=(KeySpec(("id",), primary=True), KeySpec(("kind", "ref"), predicate="id > 1")),
    foreign_keys=(ForeignKeySpec(("ref",), "parent", ("id",)),),
)


def test_versioned_load_keeps_the_old_rows_until_the_new_ones_are_whole(spark, tmp_path):
    options = LoadOptions(versioned=True, max_records_per_file=2)
    rows = spark.createDataFrame([("1", "a", "7"), ("2", "b", None), ("x", "a", "1")], "id string, kind string, ref string")
    loaded = load_table(rows, VERSIONED, "mysql", str(tmp_path), options)
    assert (loaded.rows, loaded.errors) == (2, 1) and loaded.rejects.count() == 1
    old = read_loaded(spark, str(tmp_path), VERSIONED)
    bad = rows.withColumn("ref", F.when(F.col("id") == "2", F.raise_error(F.lit("broken off"))).otherwise(F.col("ref")))
    with pytest.raises(Exception, match="broken off"):
        load_table(bad, VERSIONED, "mysql", str(tmp_path), options)
    assert read_loaded(spark, str(tmp_path), VERSIONED).count() == 2
    load_table(rows.limit(0), VERSIONED, "mysql", str(tmp_path), options)
    assert read_loaded(spark, str(tmp_path), VERSIONED).count() == 0 and old.count() == 2
    with pytest.raises(ValueError, match="append"):
        load_table(rows, VERSIONED, "mysql", str(tmp_path), LoadOptions(versioned=True, mode="append"))
    with pytest.raises(ValueError, match="already"):
        load_table(rows, VERSIONED, "mysql", str(tmp_path), LoadOptions(versioned=True, mode="create"))


def test_all_checks_of_a_table_share_one_scan(spark, tmp_path):
    from sparkload import check_table

    rows = [(1, "a", 7), (1, "b", 8), (2, "a", 7), (3, "a", 7), (4, "c", None), (None, "a", 99), (5, None, 7)]
    spark.createDataFrame(rows, "id int, kind string, ref int").repartition(3).write.parquet(f"{tmp_path}/t")
    spark.createDataFrame([(7,), (9,), (None,), (7,)], "id bigint").write.parquet(f"{tmp_path}/p")
    df, parent = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/p")
    found = check_table(df, VERSIONED, {"parent": parent})
    assert sorted(map(tuple, found.collect())) == [
        ("enum", "kind", 1, 1),
        ("foreign key", "ref", 2, 2),
        ("not null", "id", 1, 1),
        ("primary key", "id", 2, 3),
        ("unique key", "kind,ref", 1, 2),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 or plan.count("Relation") == 2  # the table and its parent
    assert check_table(df, VERSIONED, {}).filter("check like 'foreign key, parent not loaded'").first().n_keys is None


def test_references_of_two_columns(spark):
    from sparkload import check_table, fk_orphans

    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, None), (9, "z"), (9, "z")], "x int, y string")
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (None, "z")], "p bigint, q string")
    for match in ("simple", "full"):
        fk = ForeignKeySpec(("x", "y"), "parent", ("p", "q"), match=match)
        spec = TableSpec("c", (ColumnSpec("x", "int"), ColumnSpec("y", "text")), foreign_keys=(fk,))
        (row,) = check_table(child, spec, {"parent": parent}).collect()
        orphans = fk_orphans(child, parent, fk).collect()
        assert (row.n_keys, row.n_rows) == (len(orphans), sum(r.n_rows for r in orphans))
