"""Agreement of two tables by a tree of hash sums: rows move only where the sums differ.

Keys fall into ``buckets`` by a hash, and these into ``parts`` by another. A bucket has the sums of two 64-bit hashes of
its rows, source plus and target minus, which are zero exactly when both sides hold the same rows (up to a
128-bit collision). Sums are made in the tasks that read the rows, so tables that agree cost one scan each and
a shuffle of ``buckets`` rows a task, however many rows they have. Only the rows in differing parts of differing
buckets are compared key by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import quote
from .compare import both_sides, compare_keys, fingerprint
from .skew import stored

BUCKETS, PARTS = 4_096, 256
_BUCKET, _PART = "_bucket", "_part"
COMPARED = "table string, src_rows bigint, tgt_rows bigint, missing bigint, extra bigint, changed bigint"


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), *[F.col(quote(k)) for k in keys]), F.lit(buckets)).cast("int")


def _part(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("part of a bucket"), *[F.col(quote(k)) for k in keys]), F.lit(parts)).cast("int")


def hash_sums(src: DataFrame, tgt: DataFrame, keys: list[str], groups: dict[str, Column]) -> DataFrame:
    """Groups of keys with ``_s`` and ``_t`` rows and the signed hash sums ``_h0``, ``_h1``."""

    def columns(df: DataFrame) -> list[Column]:
        hashes = [h.cast("decimal(38,0)").alias(f"_h{i}") for i, h in enumerate(fingerprint(df))]
        return [*[c.alias(name) for name, c in groups.items()], *hashes]

    sign = F.col("_s") - F.col("_t")
    return both_sides(src, tgt, columns).groupBy(*groups).agg(
        F.sum("_s").alias("_s"), F.sum("_t").alias("_t"), *[F.sum(F.when(sign > 0, F.col(h)).otherwise(-F.col(h))).alias(h) for h in ("_h0", "_h1")]
    )


def _differs() -> Column:
    return (F.col("_s") != F.col("_t")) | (F.col("_h0") != 0) | (F.col("_h1") != 0)


def _narrowed(src: DataFrame, tgt: DataFrame, keys: list[str], buckets: int, parts: int) -> tuple[int, int, tuple[DataFrame, DataFrame] | None]:
    """Rows of both sides, and the rows in differing parts, None where the tables agree.

    The broadcasts hold a number for each differing bucket, then one for each differing part: ``buckets`` and
    ``buckets * parts`` of them at most, whatever the tables' size.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("buckets are made from key columns; name them")
    sums = stored(hash_sums(src, tgt, keys, {_BUCKET: _bucket(keys, buckets)}), "bucket-sums")
    totals = sums.agg(F.sum("_s").alias("s"), F.sum("_t").alias("t"), F.count_if(_differs()).alias("differing")).first()
    if not totals.differing:
        return totals.s or 0, totals.t or 0, None
    differing = F.broadcast(sums.filter(_differs()).select(_BUCKET))

    def within(df: DataFrame) -> DataFrame:
        return df.join(differing, _bucket(keys, buckets) == F.col(_BUCKET), "left_semi")

    src, tgt = within(src), within(tgt)
    if totals.differing > buckets // 2:  # most of the table differs: a second look would not spare much
        return totals.s or 0, totals.t or 0, (src, tgt)
    place = _bucket(keys, buckets).cast("bigint") * parts + _part(keys, parts)
    fine = stored(hash_sums(src, tgt, keys, {_PART: place}).filter(_differs()).select(_PART), "part-sums")

    def inside(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(fine), place == F.col(_PART), "left_semi")

    return totals.s or 0, totals.t or 0, (inside(src), inside(tgt))


def compare_by_buckets(
    src: DataFrame, tgt: DataFrame, keys, table: str = "", buckets: int = BUCKETS, parts: int = PARTS
) -> DataFrame:
    """One row as ``compare_tables`` gives by key: table, src_rows, tgt_rows, missing, extra, changed.

    Tables that agree are settled by the bucket sums alone.
    """
    s, t, rest = _narrowed(src, tgt, list(keys), buckets, parts)
    if rest is None:
        return src.sparkSession.createDataFrame([(table, s, t, 0, 0, 0)], COMPARED)
    found = compare_keys(*rest, list(keys)).agg(
        *[F.count_if(F.col("status") == name).alias(name) for name in ("missing", "extra", "changed")]
    )
    return found.select(F.lit(table).alias("table"), F.lit(s).cast("bigint").alias("src_rows"), F.lit(t).cast("bigint").alias("tgt_rows"), "missing", "extra", "changed")


def differing_keys(src: DataFrame, tgt: DataFrame, keys, buckets: int = BUCKETS, parts: int = PARTS) -> DataFrame:
    """The keys that differ, with ``status``: missing in the target, extra there, or changed."""
    keys = list(keys)
    _, _, rest = _narrowed(src, tgt, keys, buckets, parts)
    if rest is None:
        return src.select(*[F.col(quote(k)) for k in keys]).limit(0).withColumn("status", F.lit(""))
    return compare_keys(*rest, keys)
