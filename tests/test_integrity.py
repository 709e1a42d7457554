import pytest
from pyspark.sql import functions as F

from sparkload.model import ColumnSpec, ForeignKeySpec, KeySpec, TableSpec
from sparkload.operators import integrity as ig
from sparkload.operators.collect import collect_ordered
from sparkload.operators.compare import compare_tables, fingerprint, row_difference, table_counts
from sparkload.operators import skew
from sparkload.operators.skew import hot_keys, skew_join


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- keys ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def keyed(spark):
    data = [(1, 1, "x"), (1, 1, "y"), (1, 2, "x"), (None, 1, "x"), (None, 1, "z"), (2, None, "x")]
    return spark.createDataFrame(data, "a int, b int, v string").cache()


def test_primary_key(spark, keyed):
    assert rows(ig.key_violations(keyed, ["a", "b"], primary=True)) == sorted(
        [(1, 1, 2, "duplicate key"), (None, 1, 2, "null key"), (2, None, 1, "null key")], key=str
    )
    assert len(rows(ig.key_violation_rows(keyed, ["a", "b"], primary=True))) == 5


def test_unique_key_ignores_nulls(spark, keyed):
    assert rows(ig.key_violations(keyed, ["a", "b"])) == [(1, 1, 2, "duplicate key")]
    assert rows(ig.key_violation_rows(keyed, ["a", "b"])) == [(1, 1, "x"), (1, 1, "y")]


def test_filtered_unique_key(spark, keyed):
    assert rows(ig.check_key(keyed, KeySpec(("a", "b"), predicate="v = 'x'"))) == []
    assert ig.key_violation_rows(keyed, ["a", "b"], predicate="v <> 'z'").count() == 2


def test_hot_key_counts_are_combined_before_the_shuffle(spark):
    df = spark.range(0, 10_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    violations = ig.key_violations(df, ["k"])
    text = plan(violations)
    assert text.index("partial_count") > text.index("Exchange") and text.count("Exchange") == 1
    assert rows(violations) == [(7, 3335, "duplicate key")]


# --- references ----------------------------------------------------------------------


def test_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "id int, pid int")
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    fk = ForeignKeySpec(("pid",), "p", ("id",))
    assert rows(ig.fk_orphans(child, parent, fk)) == [(9, 2, "no parent")]
    assert rows(ig.fk_orphan_rows(child, parent, fk)) == [(2, 9), (3, 9)]


def test_composite_orphans_by_match_rule(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (None, 2), (None, None)], "a int, b int")
    parent = spark.createDataFrame([(1, 1), (None, 2)], "x int, y int")
    simple = ForeignKeySpec(("a", "b"), "p", ("x", "y"))
    full = ForeignKeySpec(("a", "b"), "p", ("x", "y"), match="full")
    assert rows(ig.fk_orphans(child, parent, simple)) == [(1, 2, 1, "no parent")]
    assert rows(ig.fk_orphans(child, parent, full)) == sorted(
        [(1, 2, 1, "no parent"), (None, 2, 1, "partly null key")], key=str
    )
    assert ig.fk_orphan_rows(child, parent, full).count() == 2


def test_self_reference(spark):
    people = spark.createDataFrame([(1, None), (2, 1), (3, 7)], "id int, boss int")
    assert rows(ig.fk_orphans(people, people, ForeignKeySpec(("boss",), "people", ("id",)))) == [(7, 1, "no parent")]


def test_anti_join_reuses_the_partitioning_of_its_aggregations(spark):
    child = spark.range(1000).select((F.col("id") % 50).alias("pid"))
    parent = spark.range(40)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orphans = ig.fk_orphans(child, parent, ForeignKeySpec(("pid",), "p", ("id",)))
        text = plan(orphans)
        assert text.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in text
        # Below the child's exchange there are counts per key already, not rows.
        assert "partial_count" in text.split("Exchange hashpartitioning")[1]
        assert orphans.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_foreign_key_names_differ_by_column():
    a, b = ForeignKeySpec(("x",), "s.p", ("id",)), ForeignKeySpec(("y",), "s.p", ("id",))
    assert a.name != b.name


def test_child_parent_join(spark):
    child = spark.createDataFrame([(10, 1), (11, 2), (12, 9)], "id int, parent_id int")
    parent = spark.createDataFrame([(1, "a"), (2, "b")], "pid int, name string")
    joined = ig.child_parent_join(child, parent, ForeignKeySpec(("parent_id",), "parent", ("pid",)))
    assert joined.columns == ["id", "parent_id", "pid", "name"]
    assert rows(joined) == [(10, 1, 1, "a"), (11, 2, 2, "b")]
    with pytest.raises(ValueError):
        ig.child_parent_join(child, parent.withColumn("id", F.lit(1)), ForeignKeySpec(("parent_id",), "p", ("pid",)))


# --- skew ----------------------------------------------------------------------------


def test_skew_join_gives_the_same_rows_as_a_plain_join(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"))
    right = spark.range(0, 3000, 5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("r"))
    plain = rows(left.join(right, ["k"]))
    skewed = skew_join(left, right, ["k"], min_rows=100)
    assert rows(skewed) == plain
    assert rows(skew_join(left, right, ["k"], min_rows=10**9)) == plain
    assert [r.k for r in hot_keys(left, ["k"], 100).collect()] == [5]
    assert "BroadcastHashJoin" in plan(skewed) and "Union" in plan(skewed)


def test_measured_size_decides_on_broadcast(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    keys = spark.range(0, 3000, 5).select(F.col("id").alias("k"))
    wanted = rows(df.join(keys, "k", "left_semi"))
    small = skew.rows_with_keys(df, keys, ["k"])
    assert rows(small) == wanted and "Exchange hashpartitioning" not in plan(small)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 5_000)
    large = skew.rows_with_keys(df, keys, ["k"], min_rows=100)
    assert rows(large) == wanted and "Union" in plan(large)
    assert rows(skew.rows_with_keys(df, keys, ["k"], min_rows=10**9)) == wanted
    with pytest.raises(ValueError):
        skew_join(df, keys, ["k"], "full")


# --- values --------------------------------------------------------------------------


def test_null_violations(spark, keyed):
    assert rows(ig.null_violations(keyed, ["a", "b", "v"])) == [("a", 2), ("b", 1)]


def test_enum_violations(spark):
    df = spark.createDataFrame([("happy",), ("sad",), ("mad",), ("mad",), (None,)], "m string")
    assert rows(ig.enum_violations(df, "m", ("happy", "sad"))) == [("mad", 2)]


def test_sequence_state(spark):
    df = spark.createDataFrame([(5, 2**62, None)], "a int, b bigint, c int")
    assert rows(ig.sequence_state(df, ["a", "b", "c"])) == [("a", 5, 6), ("b", 2**62, 2**62 + 1), ("c", 1, 2)]
    assert rows(ig.sequence_state(df.limit(0), ["a"])) == [("a", 1, 2)]


def test_check_table(spark, keyed):
    spec = TableSpec(
        "t",
        (ColumnSpec("a", "int", nullable=False), ColumnSpec("b", "int"), ColumnSpec("v", "text")),
        keys=(KeySpec(("a", "b"), primary=True), KeySpec(("v",))),
        foreign_keys=(ForeignKeySpec(("b",), "p", ("id",)),),
    )
    parent = spark.createDataFrame([(1,)], "id int")
    got = {r.check: (r.n_keys, r.n_rows) for r in ig.check_table(keyed, spec, {"p": parent}).collect()}
    assert got == {"primary key": (3, 5), "unique key": (1, 4), "foreign key": (1, 1), "not null": (1, 2)}
    assert ig.check_table(keyed, TableSpec("t", ())).count() == 0


# --- comparison ----------------------------------------------------------------------


def test_compare_whole_rows(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "id int, v string")
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id int, v string")
    for fp in (False, True):
        assert rows(compare_tables(src, tgt, table="t", by_fingerprint=fp)) == [("t", 4, 4, 2, 2)]
    assert rows(row_difference(src, tgt)) == sorted(
        [(2, "b", 1, 0), (3, None, 1, 0), (3, "c", 0, 1), (4, "d", 0, 1)], key=str
    )


def test_compare_by_key(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "id int, v string")
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id int, v string")
    got = compare_tables(src, tgt, ["id"], "t").first().asDict()
    assert got == {"table": "t", "src_rows": 4, "tgt_rows": 4, "missing": 0, "extra": 1, "changed": 2}


def test_equal_and_empty_tables(spark):
    df = spark.range(1000)
    assert rows(compare_tables(df, df.repartition(7))) == [("", 1000, 1000, 0, 0)]
    assert rows(compare_tables(df.limit(0), df.limit(0))) == [("", 0, 0, 0, 0)]
    with pytest.raises(ValueError):
        compare_tables(df, df.toDF("x"))


def test_fingerprint_sees_where_the_null_is(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert df.select(fingerprint(df)[0].alias("h")).distinct().count() == 2


def test_comparison_of_maps_and_variants(spark):
    src = spark.sql("SELECT map('a', 1, 'b', 2) AS m, parse_json('{\"k\": 1}') AS j")
    tgt = spark.sql("SELECT map('b', 2, 'a', 1) AS m, parse_json('{\"k\":1}') AS j")
    assert rows(compare_tables(src, tgt)) == [("", 1, 1, 0, 0)]


def test_table_counts(spark):
    assert rows(table_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


# --- ordered lists -------------------------------------------------------------------


def test_collect_ordered_in_blocks(spark):
    df = spark.createDataFrame(
        [("k", i, f"v{i}") for i in (3, 1, 2, 5, 4)] + [("z", 1, None), ("z", 2, "b")], "k string, o int, v string"
    )
    whole = {r.k: r["values"] for r in collect_ordered(df, ["k"], "v", "o").collect()}
    assert whole == {"k": ["v1", "v2", "v3", "v4", "v5"], "z": [None, "b"]}
    blocks = rows(collect_ordered(df, ["k"], "v", "o", block=2).select("k", "block", "n", F.array_join("values", "", "_")))
    assert blocks == [("k", 0, 2, "v1v2"), ("k", 1, 2, "v3v4"), ("k", 2, 1, "v5"), ("z", 0, 2, "_b")]


def test_collect_ordered_uses_one_exchange_and_refuses_double_positions(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b")], "k string, o int, v string")
    out = collect_ordered(df, ["k"], "v", "o")
    assert plan(out).count("Exchange") == 1
    with pytest.raises(Exception, match="position occurs twice"):
        out.collect()
