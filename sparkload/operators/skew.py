"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import quote
from ..session import scratch_dir

# No more keys than this are ever treated as hot. Any key left over holds less than
# 1/HOT_KEYS of the rows, which an ordinary shuffle spreads well.
HOT_KEYS = 10_000
HOT_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def hot_keys(df: DataFrame, on, min_rows: int = HOT_ROWS) -> DataFrame:
    """The most frequent keys, at most ``HOT_KEYS``, each with ``min_rows`` rows or more.

    Counts are combined before the shuffle, so a hot key costs one row per task.
    """
    counts = df.groupBy(*[F.col(quote(c)) for c in on]).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") >= min_rows).orderBy(F.col("_n").desc()).limit(HOT_KEYS).drop("_n")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of a stored frame, in one aggregate."""
    row = F.to_json(F.struct(*[F.col(quote(c)).cast("string").alias(c) for c in df.columns]))
    return df.agg(F.sum(F.octet_length(row) + F.lit(64)).cast("bigint").alias("b")).first().b or 0


def rows_with_keys(df: DataFrame, keys: DataFrame, on, min_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (distinct keys).

    ``keys`` is stored and measured first. A small set is broadcast and ``df`` is not
    shuffled at all; with a large one ``skew_join`` joins them.
    """
    found = stored(keys.select(*[quote(c) for c in on]), "keys")
    if measured_bytes(found) <= BROADCAST_BYTES:
        return df.join(F.broadcast(found), list(on), "left_semi")
    return skew_join(df, found, on, "left_semi", min_rows)


def skew_join(left: DataFrame, right: DataFrame, on, how: str = "inner", min_rows: int | None = None) -> DataFrame:
    """Inner or left semi join on equally named columns where keys of ``left`` may be hot.

    By default one ordinary join, whose skewed partitions adaptive execution splits. With ``min_rows``, keys of so
    many rows are counted first, at the cost of a pass over ``left``, and joined apart. Rows of hot keys meet a broadcast copy of their few right-hand rows and are never
    shuffled; all other rows take an ordinary join. Without hot keys, or where the
    right-hand rows of the hot keys are too large to broadcast, one ordinary join does it,
    whose skewed partitions adaptive execution splits.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"how must be inner or left_semi, not {how!r}")
    on = list(on)
    if min_rows is None:
        return left.join(right, on, how)
    hot = stored(hot_keys(left, on, min_rows), "hot")
    hot_bytes = measured_bytes(hot)
    if hot_bytes == 0 or hot_bytes > BROADCAST_BYTES:
        return left.join(right, on, how)
    hot_right = stored(right.join(F.broadcast(hot), on, "left_semi"), "hot-right")
    if measured_bytes(hot_right) > BROADCAST_BYTES:
        return left.join(right, on, how)
    hot_rows = left.join(F.broadcast(hot), on, "left_semi").join(F.broadcast(hot_right), on, how)
    other_rows = left.join(F.broadcast(hot), on, "left_anti").join(right, on, how)
    return hot_rows.unionByName(other_rows)
