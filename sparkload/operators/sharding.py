"""Key-range shards for parallel scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import quote
from ..model import PartitionSpec
from .partitioning import partition_name


def pk_ranges(low: int | None, high: int | None, shards: int) -> list[tuple[int, int]]:
    """Half-open key ranges of equal width that cover ``low`` .. ``high``.

    The last range ends just past ``high`` and so takes the remainder. No rows (NULL
    bounds) or a single shard give no ranges.
    """
    if shards <= 1 or low is None or high is None:
        return []
    width = max(1, (high - low) // shards)
    starts = [low + i * width for i in range(shards)]
    return [(s, s + width) for s in starts[:-1]] + [(starts[-1], high + 1)]


def range_predicates(quoted_key: str, ranges) -> list[str]:
    """Ranges as SQL predicates; ranges that cannot hold a key are left out."""
    return [f"{quoted_key} >= {lo} AND {quoted_key} < {hi}" for lo, hi in ranges if lo < hi]


def shard_predicates(quoted_key: str, low, high, shards: int) -> list[str]:
    return range_predicates(quoted_key, pk_ranges(low, high, shards))


def balanced_ranges(low: int | None, high: int | None, shards: int, measure, rounds: int = 4) -> list[tuple[int, int]]:
    """``pk_ranges``, with the ranges that hold far more rows than others split further.

    Keys cluster: one far-off key makes equal widths put all other rows into one range.
    ``measure(ranges)`` gives {index: (rows, lowest key, highest key)} for a list of
    ranges, by one aggregate query. The result always covers ``low`` .. ``high`` without
    gaps; ranges without rows are joined to a neighbour.
    """
    ranges = [r for r in pk_ranges(low, high, shards) if r[0] < r[1]]
    for _ in range(rounds):
        found = measure(ranges) if ranges else {}
        share = max(1, sum(n for n, _, _ in found.values()) // shards)
        split, grew = [], False
        for i, (lo, hi) in enumerate(ranges):
            n, first, last = found.get(i, (0, lo, lo))
            if n == 0 and split:
                split[-1] = (split[-1][0], hi)
            elif n > 2 * share and last > first:
                # Cut where the rows are, into as many pieces as the rows are shares, so that the
                # number of ranges stays near ``shards``; the outer pieces keep the range's ends.
                starts = [p[0] for p in pk_ranges(first, last, 1 + n // share) if p[0] <= last]
                cuts = [lo, *starts[1:], hi]
                split += list(zip(cuts, cuts[1:]))
                grew = True
            else:
                split.append((lo, hi))
        ranges = split
        if not grew:
            break
    return ranges


def measure_ranges(df: DataFrame, key: str):
    """The ``measure`` function of ``balanced_ranges`` for a frame: one aggregation per call."""

    def measure(ranges):
        spec = PartitionSpec("range", quote(key), tuple((str(i), lo, hi) for i, (lo, hi) in enumerate(ranges)))
        rows = df.groupBy(partition_name(spec).cast("int").alias("i")).agg(
            F.count(F.lit(1)).alias("n"), F.min(quote(key)).alias("lo"), F.max(quote(key)).alias("hi")
        )
        return {r.i: (r.n, int(r.lo), int(r.hi)) for r in rows.filter("i is not null").collect()}

    return measure


def is_shardable(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.IntegralType) or (
        isinstance(data_type, T.DecimalType) and data_type.scale == 0
    )


def key_bounds(df: DataFrame, key: str) -> tuple[int | None, int | None]:
    """Min and max of the key: one row back to the driver."""
    row = df.agg(F.min(quote(key)).alias("lo"), F.max(quote(key)).alias("hi")).first()
    return (None, None) if row.lo is None else (int(row.lo), int(row.hi))


def shard_by_pk(df: DataFrame, key: str, shards: int, bounds: tuple | None = None) -> DataFrame:
    """Add ``shard_id`` (from 0), the range of ``pk_ranges`` that holds the key.

    A projection only. Ranges have equal width, not equal numbers of rows. A table
    that cannot be sharded (no integral key, one shard, no rows) has shard 0 alone.
    """
    if shards <= 1 or not is_shardable(df.schema[key].dataType):
        return df.withColumn("shard_id", F.lit(0).cast("bigint"))
    low, high = bounds or key_bounds(df, key)
    if low is None:
        return df.withColumn("shard_id", F.lit(0).cast("bigint"))
    width = max(1, (high - low) // shards)
    # Decimal arithmetic only where the distance itself does not fit 64 bits.
    number = "bigint" if high - low < 2**63 else "decimal(38,0)"
    distance = f"(cast({quote(key)} as {number}) - cast({low} as {number}))"
    return df.withColumn("shard_id", F.least(F.expr(f"{distance} div cast({width} as {number})"), F.lit(shards - 1)))
