"""Enum labels in their declared order: ranks for comparing, sorting and bounding, and checks against long lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quote
from .skew import rows_with_keys, stored

CONSTANT_LABELS = 1_000  # so many become a constant of the plan; a longer list is joined
LABEL, RANK = "label", "rank"


def label_ranks(spark: SparkSession, labels) -> DataFrame:
    """``label, rank`` of an enum in declared order, counting from 1."""
    labels = list(labels)
    if len(set(labels)) < len(labels):
        raise ValueError("a label is declared twice")
    return spark.createDataFrame([(v, k) for k, v in enumerate(labels, 1)], f"{LABEL} string, {RANK} int")


def rank_of(value: Column, labels) -> Column:
    """Place of a value among a short list of labels, null for any other value; it compares and sorts as the enum does."""
    found = F.array_position(F.array(*[F.lit(v) for v in labels]), value)
    return F.when(found > 0, found.cast("int"))


def with_rank(df: DataFrame, col: str, labels, rank: str = RANK) -> DataFrame:
    """Rows with the rank of ``col``, null where it is no label.

    ``labels`` is a list, or a table ``label, rank``. A table is stored and joined by equality; its size decides
    between a broadcast and a shuffle.
    """
    if isinstance(labels, DataFrame):
        ranks = stored(labels.select(F.col(LABEL).alias("_label"), F.col(RANK).alias("_rank")), "labels")
        return df.join(ranks, F.col(quote(col)) == F.col("_label"), "left").withColumn(rank, F.col("_rank")).drop("_label", "_rank")
    labels = list(labels)
    if len(labels) > CONSTANT_LABELS:
        return with_rank(df, col, label_ranks(df.sparkSession, labels), rank)
    return df.withColumn(rank, rank_of(F.col(quote(col)), labels))


def label_bounds(df: DataFrame, col: str, labels, by=()) -> DataFrame:
    """Least and greatest label by declared order, and rows that have one, for each group: ``low, high, n_rows``."""
    ranked = with_rank(df, col, labels, "_r").filter("_r IS NOT NULL")
    pair = F.struct(F.col("_r"), F.col(quote(col)).alias("v"))
    return ranked.groupBy(*[F.col(quote(c)) for c in by]).agg(
        F.min(pair)["v"].alias("low"), F.max(pair)["v"].alias("high"), F.count(F.lit(1)).alias("n_rows")
    )


def unknown_labels(df: DataFrame, col: str, labels: DataFrame) -> DataFrame:
    """Values that are no label of a table of labels, with their rows: ``value, n_rows``.

    Rows are counted by value first, so a hash anti join meets different values alone.
    """
    counted = df.filter(F.col(quote(col)).isNotNull()).groupBy(F.col(quote(col)).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(labels.select(F.col(LABEL)), F.col("value") == F.col(LABEL), "left_anti")


def rows_with_unknown_labels(df: DataFrame, col: str, labels: DataFrame) -> DataFrame:
    """The rows themselves."""
    return rows_with_keys(df, unknown_labels(df, col, labels).select(F.col("value").alias(col)), [col])
