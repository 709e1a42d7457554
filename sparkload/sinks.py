"""Writing tables: COPY text, load modes, partitioned targets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.copytext import encode_row
from .functions.text import quote
from .model import PartitionSpec
from .operators.partitioning import PARTITION, route_partition
from .session import session_conf

# Load mode -> save mode of a file target.
SAVE_MODES = {"drop_create": "overwrite", "create": "errorifexists", "truncate": "overwrite", "append": "append"}
MODES = tuple(SAVE_MODES)


# --- COPY text -----------------------------------------------------------------------


def encode_copy_text(df: DataFrame) -> DataFrame:
    """Every row as one COPY line in the column ``value``."""
    return df.select(encode_row(df.schema).alias("value"))


def write_copy_text(df: DataFrame, path: str, table: str = "", compression: str = "none") -> str:
    """Write COPY lines below ``path``/data and table and column names to ``path``/manifest.

    Returns the data folder. Each task writes its own part files; nothing is shuffled.
    """
    root = path.rstrip("/")
    writer = encode_copy_text(df).write.mode("overwrite").option("lineSep", "\n").option("compression", compression)
    writer.text(f"{root}/data")
    manifest = json.dumps({"table": table, "columns": df.columns})
    df.sparkSession.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{root}/manifest"
    )
    return f"{root}/data"


def read_manifest(spark, path: str) -> dict:
    return json.loads(spark.read.text(f"{path.rstrip('/')}/manifest").first().value)


# --- load modes ----------------------------------------------------------------------


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "create",
    fmt: str = "parquet",
    schema_only: bool = False,
    jdbc: dict | None = None,
    batch_rows: int = 50_000,
    max_records_per_file: int = 0,
    comment: str | None = None,
) -> None:
    """Write a table by load mode.

    drop_create replaces table and schema, create refuses an existing one, truncate
    empties it and keeps its schema, append adds. ``fmt`` is a file format (``target`` is
    a path), 'table' (a catalog table) or 'jdbc' (a table behind ``jdbc['url']``).
    ``schema_only`` writes no rows. ``comment`` is kept with a catalog table.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    rows = df.filter(F.lit(False)) if schema_only else df
    if fmt == "jdbc":
        _write_jdbc(rows, target, mode, dict(jdbc or {}), batch_rows)
    elif fmt == "table":
        _write_catalog_table(rows, target, mode, max_records_per_file, comment)
    else:
        if mode == "truncate":
            stored = rows.sparkSession.read.format(fmt).load(target)
            require_same_columns(stored.columns, rows.columns)
            rows = rows.select(*[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in stored.schema.fields])
        writer = rows.write.format(fmt).mode(SAVE_MODES[mode]).option("maxRecordsPerFile", max_records_per_file)
        writer.save(target)


def require_same_columns(stored: list[str], rows: list[str]) -> None:
    """A truncated table keeps its columns, so the new rows must bring the same ones."""
    if set(stored) != set(rows):
        raise ValueError(f"truncate keeps the columns {stored}, not {rows}")


def _write_catalog_table(rows: DataFrame, target: str, mode: str, max_records_per_file: int, comment) -> None:
    spark = rows.sparkSession
    if mode == "drop_create":
        spark.sql(f"DROP TABLE IF EXISTS {target}")
    if mode in ("drop_create", "create"):
        rows.write.format("parquet").mode("errorifexists").option(
            "maxRecordsPerFile", max_records_per_file
        ).saveAsTable(target)
        if comment:
            spark.sql(f"COMMENT ON TABLE {target} IS :comment", args={"comment": comment})
        return
    columns = spark.table(target).columns
    if mode == "truncate":
        spark.sql(f"TRUNCATE TABLE {target}")
    rows.select(*[F.col(quote(c)) for c in columns]).write.insertInto(target)


def jdbc_ready(rows: DataFrame) -> DataFrame:
    """Variants as JSON text, which is what a database driver takes."""
    return rows.select(
        *[
            (F.to_json(F.col(quote(f.name))) if isinstance(f.dataType, T.VariantType) else F.col(quote(f.name))).alias(f.name)
            for f in rows.schema.fields
        ]
    )


def _write_jdbc(rows: DataFrame, target: str, mode: str, options: dict, batch_rows: int) -> None:
    rows = jdbc_ready(rows)
    writer = rows.write.format("jdbc").mode(SAVE_MODES[mode]).options(**options).option("dbtable", target)
    writer.option("batchsize", batch_rows).option("truncate", str(mode == "truncate").lower()).save()


# --- partitioned targets -------------------------------------------------------------


def write_partitioned(
    df: DataFrame,
    spec: PartitionSpec,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    gather: bool = True,
    open_files: int = 64,
) -> DataFrame:
    """Write rows below ``path``/partition_name=<name>; returns the rows no partition takes.

    ``gather`` shuffles the rows of a partition into few files; adaptive execution splits a
    partition that is far larger than the others, so a hot partition is still written by
    many tasks. Without it nothing is shuffled and every task writes its own file per
    partition, which suits few partitions. A task keeps up to ``open_files`` files open
    before it falls back to sorting.
    """
    routed = route_partition(df, spec)
    rows = routed.filter(F.col(PARTITION).isNotNull())
    if gather:
        rows = rows.hint("rebalance", F.col(PARTITION))
    with session_conf(df.sparkSession, spark__sql__maxConcurrentOutputFileWriters=str(open_files)):
        writer = rows.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(PARTITION)
        writer.format(fmt).save(path)
    return routed.filter(F.col(PARTITION).isNull()).drop(PARTITION)
