"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quote
from ..operators.skew import stored
from ..session import ship_package

__all__ = ["begin", "col", "held", "id_and_text", "map_texts", "packed", "query_partitions", "release", "stored", "text_of", "unpacked", "with_ids", "without_ids"]


def col(name: str) -> Column:
    return F.col(quote(name))


def text_of(name: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``id`` (long) and ``text`` (never null): other columns cannot clash with an operator's own."""
    return docs.select(col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))


def packed(docs: DataFrame) -> DataFrame:
    """All columns of a row in one struct named ``row``, so that nothing added beside it can clash."""
    return docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def query_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_texts(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    at_once: int | None = None,
    let_go: bool = False,
) -> DataFrame:
    """Apply a function to every Arrow batch of a frame; Spark bounds a batch by rows and by bytes.

    With ``at_once`` it gets slices of as many rows. With ``let_go`` a task that ends gives back what its worker holds, for
    workers whose memory the stages after it need.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, at_once or max(1, batch.num_rows)):
                out = function(batch.slice(low, at_once))
                if out is not None:
                    yield out
        if let_go:
            release()

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


BROADCAST_ROWS = 2_000_000  # ids; 8 bytes each, some 100 MB as a relation in memory at most


def _sized(ids: DataFrame) -> DataFrame:
    """Distinct ids, stored and counted: broadcast up to ``BROADCAST_ROWS``, otherwise joined by a shuffle."""
    found = stored(ids.select(F.col(ids.columns[0]).cast("long").alias("_wanted")).distinct(), "ids")
    return found.hint("broadcast") if found.count() <= BROADCAST_ROWS else found


def with_ids(docs: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is in the one column of ``ids``; the rows are not shuffled while the ids are few."""
    found = _sized(ids)
    return docs.join(found, docs[quote(id_col)] == found["_wanted"], "left_semi")


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is not in the one column of ``ids``, rows without an id among them."""
    found = _sized(ids)
    return docs.join(found, docs[quote(id_col)] == found["_wanted"], "left_anti")


_HELD: dict[tuple, object] = {}


def held(kind: str, key, make):
    """One large helper at a time in a Python worker: asking for another kind or key lets go of the one before.

    Workers outlive the stages that they serve; without this each would end up holding the caches of all operators.
    """
    if (kind, key) not in _HELD:
        release()
        _HELD[kind, key] = make()
    return _HELD[kind, key]


def begin(kind: str) -> None:
    """For tasks without a large helper of their own: let go of what other operators left in this worker."""
    held(kind, None, object)


def release() -> None:
    """Let go of the helper held and give the memory back to the system."""
    if _HELD:
        _HELD.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        import ctypes

        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
