"""Choosing tables, listing them, and turning views into tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quote


def table_pattern(pattern: str) -> str:
    r"""A name pattern as a Java regex for ``rlike``.

    ``~/re/`` is an unanchored regex. Anything else, quoted or not, matches the whole
    name, with ``%`` and ``_`` as wildcards. Upper and lower case never matter.
    """
    regex = re.fullmatch(r"~/(.*)/", pattern, re.DOTALL)
    if regex:
        body = regex.group(1)
    else:
        if len(pattern) > 1 and pattern[0] == pattern[-1] == "'":
            pattern = pattern[1:-1]
        wildcards = {"%": ".*", "_": "."}
        body = r"\A" + "".join(wildcards.get(ch) or re.escape(ch) for ch in pattern) + r"\z"
    try:
        re.compile(body.replace(r"\z", r"\Z"))
    except re.error as e:
        raise ValueError(f"invalid table pattern {pattern!r}: {e}") from e
    return "(?i)" + body


def name_matches(name: Column, patterns) -> Column:
    """True where the name matches any pattern."""
    out = F.lit(False)
    for p in patterns:
        out = out | name.rlike(table_pattern(p))
    return out


def select_tables(names: DataFrame, including=(), excluding=(), column: str = "table_name") -> DataFrame:
    """Keep included names (no list: all), then drop excluded ones; in name order."""
    name = F.col(quote(column))
    out = names
    if including:
        out = out.filter(name_matches(name, including))
    if excluding:
        out = out.filter(~name_matches(name, excluding))
    return out.orderBy(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(schema_name, table_name) of the catalog's base tables: no views, in order."""
    rows = [
        (t.namespace[-1] if t.namespace else None, t.name)
        for t in spark.catalog.listTables(database)
        if t.tableType in ("MANAGED", "EXTERNAL")
    ]
    return spark.createDataFrame(rows, "schema_name string, table_name string").orderBy("schema_name", "table_name")


def view_names(spark: SparkSession, names="*") -> list[str]:
    """'*' is every view of the current database; a list is taken as it is."""
    if names != "*":
        return [names] if isinstance(names, str) else list(names)
    return sorted(
        ".".join([*(t.namespace or []), t.name])
        for t in spark.catalog.listTables()
        if t.tableType in ("VIEW", "TEMPORARY")
    )


def materialize_views(
    spark: SparkSession, names="*", target: str = "", as_tables: bool = False, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Store each view's rows under the view's own name and return the stored frames.

    ``target`` is a folder, or with ``as_tables`` a database. A view name may carry its schema, and where views of
    different schemas share a name their stored names do too: ``schema.view`` as a folder, ``schema__view`` as a table.
    """
    stored = {}
    every = view_names(spark, names)
    shorts = [name.split(".")[-1].lower() for name in every]
    for name in every:
        rows = spark.table(name)
        short = name.split(".")[-1]
        if shorts.count(short.lower()) > 1:
            short = name.replace(".", "__") if as_tables else name
        if as_tables:
            table = f"{quote(target)}.{quote(short)}"
            rows.write.format(fmt).mode("overwrite").saveAsTable(table)
            stored[name] = spark.table(table)
        else:
            path = f"{target.rstrip('/')}/{short}"
            rows.write.format(fmt).mode("overwrite").save(path)
            stored[name] = spark.read.schema(rows.schema).format(fmt).load(path)
    return stored
