"""Good rows and rejected rows of a load, from one pass over the source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import quote
from .casting import ERRORS, cast_table

OUTCOME = "load_outcome"
GOOD, REJECTED = "good", "rejected"


@dataclass(frozen=True)
class LoadResult:
    """Both frames are lazy; each good row appears once, each bad value is one reject row."""

    good: DataFrame
    rejects: DataFrame


def reject_rows(checked: DataFrame, table: str, key_columns=()) -> DataFrame:
    """One row per bad value: table, key (JSON of the raw key), column, value, reason."""
    key = F.to_json(F.struct(*[F.col(quote(f"_key_{k}")).cast("string").alias(k) for k in key_columns])) if (
        key_columns
    ) else F.lit(None).cast("string")
    return (
        checked.filter(F.col(ERRORS).isNotNull())
        .select(F.lit(table).alias("table"), key.alias("key"), F.explode(ERRORS).alias("e"))
        .select("table", "key", "e.column", "e.value", "e.reason")
    )


def checked_rows(df: DataFrame, columns, dialect: str, user_rules=(), key_columns=(), where=None) -> DataFrame:
    """Cast rows plus ``_errors`` plus the raw key under ``_key_<name>``."""
    with_keys = df.select("*", *[F.col(quote(k)).alias(f"_key_{k}") for k in key_columns])
    return cast_table(
        with_keys, columns, dialect, user_rules, on_error="reject", keep=tuple(f"_key_{k}" for k in key_columns), where=where
    )


def split_checked(checked: DataFrame, columns, table: str, key_columns=()) -> LoadResult:
    good = checked.filter(F.col(ERRORS).isNull()).select(*[F.col(quote(c.name)) for c in columns])
    return LoadResult(good, reject_rows(checked, table, key_columns))


def load_with_rejects(
    df: DataFrame, columns, dialect: str, user_rules=(), table: str = "", key_columns=(), where=None
) -> LoadResult:
    """Split a raw table into castable rows and rejects with reasons.

    Both results come lazily from the same plan; use ``write_checked`` to store them
    with a single pass over the source. ``where`` selects source rows before the casts.
    """
    checked = checked_rows(df, columns, dialect, user_rules, key_columns, where)
    return split_checked(checked, columns, table, key_columns)


def write_checked(checked: DataFrame, path: str, columns, table: str, key_columns=(), fmt: str = "parquet"):
    """Write good and rejected rows in one job and return them read back.

    The source is scanned and cast once: rows go to ``load_outcome=good`` or
    ``load_outcome=rejected`` below ``path``.
    """
    outcome = F.when(F.col(ERRORS).isNull(), GOOD).otherwise(REJECTED)
    rows = checked.withColumn(OUTCOME, outcome)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(OUTCOME)
    writer.format(fmt).save(path)
    stored = checked.sparkSession.read.schema(rows.schema).format(fmt).load(path)
    good = stored.filter(F.col(OUTCOME) == GOOD).select(*[F.col(quote(c.name)) for c in columns])
    return LoadResult(good, reject_rows(stored.filter(F.col(OUTCOME) == REJECTED), table, key_columns))
