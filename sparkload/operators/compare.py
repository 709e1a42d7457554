"""Agreement of source and target tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import quote


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows) of several tables, as one union."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _groupable(df: DataFrame) -> list[Column]:
    """Every column in a form that can be grouped: JSON text for variants, entries for maps."""
    out = []
    for f in df.schema.fields:
        c = F.col(quote(f.name))
        if isinstance(f.dataType, T.VariantType):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.MapType):
            c = F.array_sort(F.map_entries(c))
        out.append(c.alias(f.name))
    return out


def fingerprint(df: DataFrame) -> list[Column]:
    """Two independent 64-bit hashes of the whole row.

    The hash skips NULLs, so each column brings its null flag along: (NULL, 'a') and
    ('a', NULL) differ.
    """
    parts = [p for f, c in zip(df.schema.fields, _groupable(df)) for p in (c, F.col(quote(f.name)).isNull())]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second hash"), *parts)]


def both_sides(src: DataFrame, tgt: DataFrame, of) -> DataFrame:
    """``of(side)`` columns of both tables in one frame, with ``_s``/``_t`` as side counters."""
    if src.columns != tgt.columns:
        raise ValueError(f"columns differ: {src.columns} / {tgt.columns}")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return src.select(*of(src), one.alias("_s"), none.alias("_t")).unionByName(
        tgt.select(*of(tgt), none.alias("_s"), one.alias("_t"))
    )


def row_difference(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``missing`` and ``extra`` copies in the target.

    Both directions come from one aggregation, and copies are combined before the shuffle.
    """
    both = both_sides(src, tgt, _groupable)
    counted = both.groupBy(*[F.col(quote(c)) for c in src.columns]).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    return counted.filter(F.col("_s") != F.col("_t")).select(
        *[F.col(quote(c)) for c in src.columns],
        F.greatest(F.col("_s") - F.col("_t"), F.lit(0)).alias("missing"),
        F.greatest(F.col("_t") - F.col("_s"), F.lit(0)).alias("extra"),
    )


def compare_tables(
    src: DataFrame, tgt: DataFrame, keys=(), table: str = "", by_fingerprint: bool = False
) -> DataFrame:
    """One row: table, src_rows, tgt_rows, missing, extra (and changed, with keys).

    Without keys whole rows are compared as multisets. With keys, ``missing`` and
    ``extra`` count keys on one side only, ``changed`` keys whose rows differ.
    ``by_fingerprint`` shuffles a 128-bit hash in place of the whole row, for wide tables.
    """
    keys = list(keys)
    if keys:
        return _compare_by_key(src, tgt, keys, table)

    def columns(df):
        return [h.alias(f"_h{i}") for i, h in enumerate(fingerprint(df))] if by_fingerprint else _groupable(df)

    both = both_sides(src, tgt, columns)
    group = [F.col(quote(c)) for c in both.columns if c not in ("_s", "_t")]
    counted = both.groupBy(*group).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    return _totals(
        counted,
        table,
        missing=F.sum(F.greatest(F.col("_s") - F.col("_t"), F.lit(0))),
        extra=F.sum(F.greatest(F.col("_t") - F.col("_s"), F.lit(0))),
    )


def _keys_of_both(src: DataFrame, tgt: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with their rows on either side and ``status``: missing, extra, changed, or null where both agree."""

    def columns(df):
        hashes = [h.cast("decimal(38,0)").alias(f"_h{i}") for i, h in enumerate(fingerprint(df))]
        return [*[F.col(quote(k)) for k in keys], *hashes]

    both = both_sides(src, tgt, columns)
    # The sum of the hashes of a key's rows, source plus and target minus, is zero exactly
    # when both sides hold the same rows (up to a 128-bit collision).
    sign = F.col("_s") - F.col("_t")
    counted = both.groupBy(*[F.col(quote(k)) for k in keys]).agg(
        F.sum("_s").alias("_s"),
        F.sum("_t").alias("_t"),
        *[F.sum(F.when(sign > 0, F.col(h)).otherwise(-F.col(h))).alias(h) for h in ("_h0", "_h1")],
    )
    differs = (F.col("_s") != F.col("_t")) | (F.col("_h0") != 0) | (F.col("_h1") != 0)
    status = F.when(F.col("_t") == 0, "missing").when(F.col("_s") == 0, "extra").when(differs, "changed")
    return counted.withColumn("status", status)


def compare_keys(src: DataFrame, tgt: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that differ, with ``status``."""
    return _keys_of_both(src, tgt, keys).filter("status IS NOT NULL").select(*[F.col(quote(k)) for k in keys], "status")


def _compare_by_key(src: DataFrame, tgt: DataFrame, keys: list[str], table: str) -> DataFrame:
    counted = _keys_of_both(src, tgt, keys)
    return _totals(counted, table, **{name: F.count_if(F.col("status") == name) for name in ("missing", "extra", "changed")})


def _totals(counted: DataFrame, table: str, **measures) -> DataFrame:
    def zero(c):
        return F.coalesce(c, F.lit(0)).cast("bigint")

    return counted.agg(
        zero(F.sum("_s")).alias("src_rows"),
        zero(F.sum("_t")).alias("tgt_rows"),
        *[zero(m).alias(name) for name, m in measures.items()],
    ).select(F.lit(table).alias("table"), "src_rows", "tgt_rows", *measures)
