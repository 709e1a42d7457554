"""Reading COPY text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.copytext import DELIMITER, END_MARK, decode_field

CORRUPT = "_corrupt_record"


def read_copy_text(spark: SparkSession, path, columns, on_ragged: str = "fail") -> DataFrame:
    """Decode COPY text files to one string column per field, in the order of ``columns``.

    Files split at line ends (a newline inside a value is always escaped), so one huge
    file is read by many tasks. A line with another number of fields fails the job, or
    with on_ragged='reject' is kept in ``_corrupt_record`` with NULL fields.
    """
    # Only the newline ends a row: the reader's default would also break at a bare CR.
    lines = spark.read.option("lineSep", "\n").text(path).filter(F.col("value") != END_MARK)
    return decode_lines(lines, columns, on_ragged)


def decode_lines(lines: DataFrame, columns, on_ragged: str = "fail") -> DataFrame:
    """Rows of encoded lines in ``value`` -> the decoded fields."""
    columns = list(columns)
    split = lines.select("value", F.split("value", DELIMITER, -1).alias("fields"))
    whole = F.size("fields") == len(columns)
    fields = [decode_field(F.get("fields", F.lit(i))) for i in range(len(columns))]
    if on_ragged == "reject":
        return split.select(
            *[F.when(whole, f).alias(c) for f, c in zip(fields, columns)],
            F.when(~whole, F.col("value")).alias(CORRUPT),
        )
    message = F.concat(F.lit(f"expected {len(columns)} fields: "), F.col("value"))
    checked = split.filter(F.when(whole, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select(*[f.alias(c) for f, c in zip(fields, columns)])
