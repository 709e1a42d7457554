"""Small text expressions shared by the readers and the transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code points of the characters that count as whitespace when trimming.
WHITESPACE = "".join(
    map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)


def trim_space(c: Column) -> Column:
    """Strip Unicode whitespace from both ends (Spark's plain ``trim`` strips only blanks)."""
    return F.btrim(c, F.lit(WHITESPACE))


def null_if_value(c: Column, values=(), keep_empty: bool = False, trim: bool = True) -> Column:
    """Trimmed value; '' (unless kept) and any of ``values`` become NULL."""
    trimmed = trim_space(c) if trim else c
    nulls = list(values) if keep_empty else ["", *values]
    return F.when(~trimmed.isin(nulls), trimmed) if nulls else trimmed


def null_if(df: DataFrame, cols=None, values=(), keep_empty: bool = False, trim: bool = True) -> DataFrame:
    """Apply ``null_if_value`` to ``cols`` (default: all) in one projection."""
    wanted = set(df.columns if cols is None else cols)
    return df.select(
        *[
            (null_if_value(F.col(quote(c)), values, keep_empty, trim) if c in wanted else F.col(quote(c))).alias(c)
            for c in df.columns
        ]
    )


def quote(name: str) -> str:
    """Back-quoted column reference; names may hold spaces, dots and quotes."""
    return "`" + name.replace("`", "``") + "`"
