"""Counts and key bounds from the footers of Parquet files, without reading their rows.

Spark pushes an aggregate into the scan of its newer Parquet source, which then reads footers alone. Types whose bounds
footers do not hold exactly, files without statistics and other formats are scanned.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import quote
from ..session import session_conf

_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)
_PUSHED = {"spark__sql__sources__useV1SourceList": "avro,csv,json,orc,text", "spark__sql__parquet__aggregatePushdown": "true"}


def _aggregated(spark: SparkSession, path: str, measures) -> tuple[DataFrame, bool]:
    """One row of measures over a Parquet folder, planned; and whether files give it without their rows."""
    with session_conf(spark, **_PUSHED):
        found = spark.read.parquet(path).agg(*measures)
        plan = found._jdf.queryExecution().executedPlan().toString()
    return found, "PushedAggregation: [" in plan and "PushedAggregation: []" not in plan


def _first(spark: SparkSession, path: str, measures: list[Column]):
    found, _ = _aggregated(spark, path, measures)
    try:
        with session_conf(spark, **_PUSHED):
            return found.first()
    except (PySparkException, Py4JJavaError):  # a file without statistics, or one that the scan cannot read either
        return spark.read.parquet(path).agg(*measures).first()


def reads_footers_alone(spark: SparkSession, path: str, *measures: Column) -> bool:
    return _aggregated(spark, path, list(measures))[1]


def counts_from_files(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table, n_rows) of Parquet folders by their footers."""
    # Footers of files without any rows sum up to nothing.
    rows = [(name, _first(spark, path, [F.count(F.lit(1)).alias("n")]).n or 0) for name, path in paths.items()]
    return spark.createDataFrame(rows, "table string, n_rows bigint")


def key_bounds_from_files(spark: SparkSession, path: str, key: str) -> tuple:
    """Least and greatest value of a column, and its rows: by footers for numbers and dates, else by a scan."""
    measures = [F.min(quote(key)).alias("low"), F.max(quote(key)).alias("high"), F.count(F.lit(1)).alias("n")]
    kind = spark.read.parquet(path).schema[key].dataType
    row = _first(spark, path, measures) if isinstance(kind, _EXACT) else spark.read.parquet(path).agg(*measures).first()
    return row.low, row.high, row.n or 0
