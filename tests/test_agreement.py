import re

import pytest
from pyspark.sql import functions as F

from sparkload import compare_tables
from sparkload.operators import agreement
from sparkload.operators.agreement import compare_by_buckets, differing_keys, hash_sums
from sparkload.publishing import (
    IncompleteVersion,
    PublishConflict,
    current_version,
    publish_version,
    published_versions,
    read_published,
    read_text_file,
    remove_old_versions,
    restore_version,
    switch_to,
    write_text_file,
)


def rows(spark, n=2_000):
    return spark.range(n).select("id", (F.col("id") % 7).alias("a"), F.concat(F.lit("t"), "id").alias("b"))


def altered(df):
    return df.filter("id % 401 <> 3").withColumn("b", F.when(F.col("id") % 503 == 5, None).otherwise(F.col("b"))).union(df.filter("id = 9").withColumn("id", F.lit(9_999).cast("long")))


@pytest.mark.parametrize("buckets", [1, 16, 4_096])
def test_buckets_equal_comparison_by_key(spark, buckets):
    src, tgt = rows(spark), altered(rows(spark))
    tgt = tgt.union(tgt.filter("id = 77"))  # one key twice
    got = compare_by_buckets(src, tgt, ["id"], "t", buckets, 8).collect()
    assert got == compare_tables(src, tgt, ["id"], "t").collect()
    assert got[0].missing == 5 and got[0].extra == 1 and got[0].changed == 5
    found = {r.id: r.status for r in differing_keys(src, tgt, ["id"], buckets, 8).collect()}
    assert found[9_999] == "extra" and found[404] == "missing" and found[77] == "changed" and len(found) == 11


def test_equal_tables_are_settled_by_bucket_sums(spark, monkeypatch):
    src = rows(spark)
    monkeypatch.setattr(agreement, "compare_keys", lambda *a: pytest.fail("rows were compared"))
    (got,) = compare_by_buckets(src, src.repartition(7), ["id"]).collect()
    assert tuple(got) == ("", 2_000, 2_000, 0, 0, 0)
    assert differing_keys(src, src, ["id"]).count() == 0


def test_only_sums_are_shuffled(spark):
    src = rows(spark)
    plan = hash_sums(src, src, ["id"], {"_bucket": agreement._bucket(["id"], 16)})._jdf.queryExecution().executedPlan().toString()
    (exchange,) = re.findall(r"Exchange hashpartitioning\((\S+?)#\d+, .*\n.*?(\w+)\(keys", plan)
    assert exchange[0] == "_bucket" and exchange[1] == "HashAggregate" and "partial_sum" in plan


def test_rows_of_differing_buckets_alone_are_compared(spark, monkeypatch):
    seen = []
    compare = agreement.compare_keys
    monkeypatch.setattr(agreement, "compare_keys", lambda s, t, k: seen.append(s.count()) or compare(s, t, k))
    src = rows(spark, 20_000)
    compare_by_buckets(src, src.withColumn("a", F.when(F.col("id") == 5, 99).otherwise(F.col("a"))), ["id"]).collect()
    assert seen[0] < 5


def test_keys_are_needed(spark):
    with pytest.raises(ValueError, match="key columns"):
        compare_by_buckets(rows(spark), rows(spark), [])


# --- versions ------------------------------------------------------------------------


def test_versions_replace_one_another(spark, tmp_path):
    target = str(tmp_path / "t")
    assert current_version(spark, target) is None
    with pytest.raises(FileNotFoundError):
        read_published(spark, target)
    publish_version(rows(spark, 10), target)
    first = read_published(spark, target)
    publish_version(rows(spark, 30).withColumn("more", F.lit(1)), target)
    assert first.count() == 10 and read_published(spark, target).count() == 30 and "more" in read_published(spark, target).columns
    assert read_published(spark, target, 1).count() == 10
    assert restore_version(spark, target, 1).number == 3 and read_published(spark, target).count() == 10
    assert [v.rows for v in published_versions(spark, target)] == [10, 30, 10]


def test_failed_load_leaves_the_old_rows(spark, tmp_path):
    target = str(tmp_path / "t")
    publish_version(rows(spark, 10), target)
    bad = rows(spark, 1_000).repartition(4).withColumn("b", F.when(F.col("id") == 700, F.raise_error(F.lit("half-way"))).otherwise(F.col("b")))
    with pytest.raises(Exception, match="half-way"):
        publish_version(bad, target)
    assert read_published(spark, target).count() == 10 and current_version(spark, target).number == 1
    with pytest.raises(IncompleteVersion):
        publish_version(rows(spark, 20), target, expected_rows=21)
    assert read_published(spark, target).count() == 10
    gone = remove_old_versions(spark, target)
    assert len(gone) == 2 and read_published(spark, target).count() == 10


def test_two_writers_do_not_lose_each_other(spark, tmp_path):
    target = str(tmp_path / "t")
    seen = publish_version(rows(spark, 10), target)
    publish_version(rows(spark, 20), target)
    with pytest.raises(PublishConflict):
        switch_to(spark, target, f"{target}/versions/other", 5, rows(spark).schema, "parquet", seen)
    assert read_published(spark, target).count() == 20
    remove_old_versions(spark, target)
    assert [v.number for v in published_versions(spark, target)] == [2]
    with pytest.raises(ValueError):
        remove_old_versions(spark, target, 0)


def test_empty_versions_keep_their_schema(spark, tmp_path):
    publish_version(rows(spark, 0), str(tmp_path / "t"))
    found = read_published(spark, str(tmp_path / "t"))
    assert found.columns == ["id", "a", "b"] and found.count() == 0


def test_small_files(spark, tmp_path):
    assert read_text_file(spark, f"{tmp_path}/x/y.json") is None
    write_text_file(spark, f"{tmp_path}/x/y.json", "é\n")
    write_text_file(spark, f"{tmp_path}/x/y.json", "zwei")
    assert read_text_file(spark, f"{tmp_path}/x/y.json") == "zwei"
