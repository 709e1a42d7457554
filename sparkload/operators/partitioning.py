"""Routing rows to the partitions of a target table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import PartitionSpec

PARTITION = "partition_name"


def _range_name(key: Column, spec: PartitionSpec) -> Column:
    """A balanced tree of comparisons: n bounds cost log n tests per row."""
    parts = list(spec.partitions)
    low_open = [p for p in parts if p[1] is None]
    bounded = sorted((p for p in parts if p[1] is not None), key=lambda p: p[1])
    ordered = low_open + bounded
    if len(low_open) > 1:
        raise ValueError("more than one range without a lower bound")
    for left, right in zip(ordered, ordered[1:]):
        if left[2] is None or left[2] > right[1]:
            raise ValueError(f"ranges {left[0]!r} and {right[0]!r} overlap")

    def leaf(part) -> Column:
        name, low, high = part
        inside = F.lit(True)
        if low is not None:
            inside = inside & (key >= F.lit(low))
        if high is not None:
            inside = inside & (key < F.lit(high))
        return F.when(inside, F.lit(name))

    def tree(some) -> Column:
        if len(some) == 1:
            return leaf(some[0])
        half = len(some) // 2
        return F.when(key < F.lit(some[half][1]), tree(some[:half])).otherwise(tree(some[half:]))

    if not ordered:
        return F.lit(None).cast("string")
    return F.when(key.isNotNull(), tree(ordered))


def _list_name(key: Column, spec: PartitionSpec) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    seen: set = set()
    for name, values in spec.partitions:
        if seen & set(values):
            raise ValueError(f"values listed twice: {sorted(map(str, seen & set(values)))}")
        seen |= set(values)
        plain = [v for v in values if v is not None]
        if plain:
            out = out.when(key.isin(*plain), F.lit(name))
        if len(plain) < len(values):
            out = out.when(key.isNull(), F.lit(name))
    return out


def partition_name(spec: PartitionSpec) -> Column:
    """Name of the partition that takes the row, NULL if there is none."""
    key = F.expr(spec.key)
    strategy = spec.strategy.lower()
    if strategy == "range":
        name = _range_name(key, spec)
    elif strategy == "list":
        name = _list_name(key, spec)
    elif strategy == "hash":
        # A layout of our own: the target database's hash function is not reproduced.
        return F.concat(F.lit(spec.prefix), F.pmod(F.xxhash64(key), F.lit(spec.modulus)).cast("string"))
    else:
        raise ValueError(f"unknown partition strategy {spec.strategy!r}")
    return F.coalesce(name, F.lit(spec.default)) if spec.default else name


def route_partition(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Add ``partition_name``; a projection only."""
    return df.withColumn(PARTITION, partition_name(spec))


def unrouted_rows(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Rows that no partition takes."""
    return route_partition(df, spec).filter(F.col(PARTITION).isNull()).drop(PARTITION)
