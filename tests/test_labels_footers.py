import pytest
from pyspark.sql import functions as F

from sparkload import collect_ordered
from sparkload.operators.collect import expand_ordered
from sparkload.operators.labels import label_bounds, label_ranks, rows_with_unknown_labels, unknown_labels, with_rank
from sparkload.sources.footers import counts_from_files, key_bounds_from_files, reads_footers_alone

SIZES = ("small", "medium", "large")


@pytest.mark.parametrize("as_table", [False, True])
def test_labels_are_ordered_as_declared(spark, as_table):
    labels = label_ranks(spark, SIZES) if as_table else SIZES
    df = spark.createDataFrame([(1, "large"), (1, "small"), (2, "medium"), (2, "tiny"), (3, None), (2, "large")], "g int, s string")
    assert [r.s for r in with_rank(df, "s", labels).filter("rank IS NOT NULL").orderBy("rank", "g").collect()] == ["small", "medium", "large", "large"]
    assert {tuple(r) for r in label_bounds(df, "s", labels, ["g"]).collect()} == {(1, "small", "large", 2), (2, "medium", "large", 2)}


def test_long_lists_are_joined(spark):
    labels = label_ranks(spark, [f"L{k}" for k in range(5_000)])
    df = spark.createDataFrame([("L4999",), ("L0",), ("x",), ("x",), (None,)], "s string")
    assert [tuple(r) for r in unknown_labels(df, "s", labels).collect()] == [("x", 2)]
    assert rows_with_unknown_labels(df, "s", labels).count() == 2
    assert {r.s: r.rank for r in with_rank(df, "s", [f"L{k}" for k in range(5_000)]).collect()}["L4999"] == 5_000
    with pytest.raises(ValueError):
        label_ranks(spark, ["a", "a"])


# --- unnest with ordinality ----------------------------------------------------------


def test_expanding_undoes_collecting(spark):
    rows = [(k % 3, p, f"v{k}-{p}") for k in range(3) for p in range(1, 50)] + [(7, 1, None), (7, 4, "gap")]
    df = spark.createDataFrame(rows, "k int, p int, v string")
    lists = collect_ordered(df, ["k"], "v", "p", block=8, positions=True)
    assert sorted(map(tuple, expand_ordered(lists, ["k"], "values", block=8).collect()), key=str) == sorted(rows, key=str)
    dense = collect_ordered(df.filter("k < 3"), ["k"], "v", "p", block=8)
    assert {tuple(r) for r in expand_ordered(dense, ["k"], "values", block=8).collect()} == {r for r in rows if r[0] < 3}


def test_arrays_advance_together(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1]), (2, None, [5]), (3, [], []), (4, None, None)], "k int, positions array<string>, p array<int>")
    got = expand_ordered(df, ["k"], ["positions", "p"], ordinality="n")
    assert got.columns == ["k", "n", "positions", "p"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 1, "a", 1), (1, 2, "b", None), (2, 1, None, 5)]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


# --- file statistics -----------------------------------------------------------------


def test_footers_give_counts_and_bounds(spark, tmp_path):
    df = spark.range(5, 1_000).select("id", F.col("id").cast("string").alias("s"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    df.repartition(3).write.parquet(f"{tmp_path}/t")
    df.limit(0).write.parquet(f"{tmp_path}/none")
    assert {tuple(r) for r in counts_from_files(spark, {"t": f"{tmp_path}/t", "none": f"{tmp_path}/none"}).collect()} == {("t", 995), ("none", 0)}
    assert key_bounds_from_files(spark, f"{tmp_path}/t", "id") == (5, 999, 995)
    assert key_bounds_from_files(spark, f"{tmp_path}/t", "s") == ("10", "999", 995)
    assert str(key_bounds_from_files(spark, f"{tmp_path}/t", "d")[0]) == "2020-01-06"
    assert reads_footers_alone(spark, f"{tmp_path}/t", F.count(F.lit(1)), F.max("id"))
    assert not reads_footers_alone(spark, f"{tmp_path}/t", F.max("s"))
    spark.conf.set("parquet.column.statistics.enabled", "false")
    df.write.option("parquet.column.statistics.enabled", "false").parquet(f"{tmp_path}/bare")
    spark.conf.unset("parquet.column.statistics.enabled")
    assert key_bounds_from_files(spark, f"{tmp_path}/bare", "id") == (5, 999, 995)
