"""Ordered lists of values per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import quote

BLOCK = 1024


def collect_ordered(
    df: DataFrame, keys, value: str, order: str, block: int = BLOCK, first: int = 1, positions: bool = False
) -> DataFrame:
    """Values per key in the order of an ordinal column: keys, block, n, values (and their ``positions``, if asked).

    ``order`` is a position that counts from ``first`` and is unique within a key. A key
    with more than ``block`` positions gives several rows, one per block of positions,
    so no list and no group grows without bound however many rows a key has. A
    position that occurs twice stops the job.
    """
    keys = list(keys)
    number = F.floor((F.col(quote(order)).cast("bigint") - F.lit(first)) / F.lit(block)).alias("block")
    rows = df.select(
        *[F.col(quote(k)) for k in keys], number, F.col(quote(order)).alias("_o"), F.col(quote(value)).alias("_v")
    )
    # One exchange on (keys, block) serves both aggregations below. The first holds one
    # value per position, so the second can never collect more than ``block`` of them.
    group = [F.col(quote(k)) for k in keys]
    placed = rows.repartition(*group, F.col("block"))
    single_values = placed.groupBy(*group, "block", "_o").agg(F.count(F.lit(1)).alias("_n"), F.first("_v").alias("_v"))
    message = F.concat(F.lit("position occurs twice: "), F.col("_o").cast("string"))
    single = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    listed = single_values.filter(single).groupBy(*group, "block").agg(
        F.array_sort(F.collect_list(F.struct("_o", "_v"))).alias("_list")
    )
    out = [*group, "block", F.size("_list").alias("n"), F.transform("_list", lambda e: e["_v"]).alias("values")]
    return listed.select(*out, *[F.transform("_list", lambda e: e["_o"]).alias("positions")] * positions)


def expand_ordered(df: DataFrame, keys, columns, ordinality: str = "ordinality", block: int = BLOCK, first: int = 1) -> DataFrame:
    """Elements of array columns side by side with their position, one row each: the inverse of ``collect_ordered``.

    The arrays in ``columns`` (a name, or several) advance together and a shorter one goes on with NULL; a NULL array is an
    empty one. Positions count from ``first``; where the rows have ``positions`` they are taken from there, else a ``block``
    column places a row's elements behind those of the blocks before it. Rows without elements give no row. A generator:
    nothing is shuffled.
    """
    keys, columns = list(keys), [columns] if isinstance(columns, str) else list(columns)
    given = "positions" in df.columns and "positions" not in columns
    filled = [F.coalesce(F.col(quote(c)), F.array().cast(df.schema[c].dataType)) for c in columns]
    fields = [*[c.alias(f"v{i}") for i, c in enumerate(filled)], *[F.col("positions").alias("at")] * given]
    renamed = df.select(
        *[F.col(quote(k)).alias(f"k{i}") for i, k in enumerate(keys)],
        (F.col("block") if "block" in df.columns else F.lit(0)).cast("bigint").alias("b"),
        *fields,
    )
    names = [f"v{i}" for i in range(len(columns))] + ["at"] * given
    each = renamed.select(*[f"k{i}" for i in range(len(keys))], "b", F.posexplode(F.arrays_zip(*names)).alias("p", "e"))
    at = F.col("e.at").cast("bigint") if given else F.col("b") * block + F.col("p") + first
    return each.select(
        *[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)],
        at.alias(ordinality),
        *[F.col(f"e.v{i}").alias(c) for i, c in enumerate(columns)],
    )
