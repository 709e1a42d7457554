"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these; ``a > b`` holds in every edge."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(least.select("a", F.col("low").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every node of the edges ``a, b``: the component is its smallest node.

    Large-star and small-star steps alternate until the edges form stars. Each step joins edges with one
    minimum per node and its result is stored, so no step depends on more than the one before. Loops
    and repeated edges do no harm.
    """
    state = F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    now = stored(now, "edges")
    before = now.agg(*state).first()
    while before[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        after = now.agg(*state).first()
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
