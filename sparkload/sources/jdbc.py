"""Tables of a relational database over JDBC."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..model import ColumnSpec, TableSpec
from ..operators.casting import plan_casts
from ..operators.sharding import balanced_ranges, is_shardable, pk_ranges, range_predicates
from ..plans.rules import base_type, resolve, with_user_rules

# MySQL types that are read as text.
SPATIAL = (
    "geometry", "point", "linestring", "polygon",
    "multipoint", "multilinestring", "multipolygon", "geometrycollection",
)

# SQL Server type -> (text length, style) of the conversion.
MSSQL_CONVERT = {
    "time": (30, 114),
    "datetime": (30, 126),
    "datetime2": (30, 126),
    "smalldatetime": (30, 126),
    "date": (30, 126),
    "datetimeoffset": (35, 127),
    "uniqueidentifier": (36, None),
}


def quote_identifier(name: str, dialect: str) -> str:
    opening, closing = {"mysql": "``", "mssql": "[]"}.get(dialect, '""')
    return opening + name.replace(closing, closing * 2) + closing


def column_expression(column: ColumnSpec, dialect: str) -> str:
    """How the source database hands over this column."""
    quoted = quote_identifier(column.name, dialect)
    kind = base_type(column.source_type).lower()
    expression = quoted
    if dialect == "mysql" and kind in SPATIAL:
        expression = f"ST_AsText({quoted})"
    elif dialect == "mssql" and kind in MSSQL_CONVERT:
        length, style = MSSQL_CONVERT[kind]
        expression = f"convert(varchar({length}), {quoted}" + (f", {style})" if style else ")")
    elif dialect == "pgsql" and resolve(with_user_rules((), dialect), column).transform == "money-to-numeric":
        expression = f"{quoted}::numeric"
    return quoted if expression == quoted else f"{expression} AS {quoted}"


def qualified_table(spec: TableSpec, dialect: str) -> str:
    return ".".join(quote_identifier(p, dialect) for p in (spec.schema, spec.name) if p)


def select_statement(spec: TableSpec, dialect: str, where: str | None = None) -> str:
    columns = ", ".join(column_expression(c, dialect) for c in spec.columns)
    return f"SELECT {columns} FROM {qualified_table(spec, dialect)}" + (f" WHERE {where}" if where else "")


def shard_key(spec: TableSpec, dialect: str) -> str | None:
    """First primary-key column if it is a whole number, else None (one partition)."""
    if not spec.primary_key:
        return None
    key = spec.column(spec.primary_key[0])
    data_type: T.DataType = plan_casts([key], dialect)[0].field.dataType
    return key.name if is_shardable(data_type) else None


def bounds_statement(spec: TableSpec, dialect: str, key: str, where: str | None = None) -> str:
    quoted = quote_identifier(key, dialect)
    tail = f" WHERE {where}" if where else ""
    return f"SELECT MIN({quoted}) AS lo, MAX({quoted}) AS hi FROM {qualified_table(spec, dialect)}{tail}"


def counts_statement(spec: TableSpec, dialect: str, key: str, ranges, where: str | None = None) -> str:
    """Rows, lowest and highest key of every range, by its position in the list."""
    quoted = quote_identifier(key, dialect)
    tests = " ".join(f"WHEN {p} THEN {i}" for i, p in enumerate(range_predicates(quoted, ranges)))
    tail = f" WHERE {where}" if where else ""
    numbered = f"SELECT CASE {tests} END AS r, {quoted} AS k FROM {qualified_table(spec, dialect)}{tail}"
    return f"SELECT r, COUNT(*) AS n, MIN(k) AS lo, MAX(k) AS hi FROM ({numbered}) s GROUP BY r"


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    spec: TableSpec,
    dialect: str,
    shards: int = 1,
    properties: dict | None = None,
    where: str | None = None,
    fetch_size: int = 10_000,
    balanced: bool = False,
) -> DataFrame:
    """Scan a table with its read expressions, one partition per key range.

    The bounds of the key come from one aggregate query; every shard then runs its own
    range query on the database, with later filters pushed into it. ``balanced`` counts the
    rows per range first, by further aggregate queries, and splits crowded ranges.
    """
    options = {"fetchsize": str(fetch_size), **(properties or {})}
    table = f"({select_statement(spec, dialect, where)}) t"
    key = shard_key(spec, dialect) if shards > 1 else None
    if key is None:
        return spark.read.jdbc(url, table, properties=options)
    found = spark.read.jdbc(url, f"({bounds_statement(spec, dialect, key, where)}) b", properties=options).first()
    low, high = (None, None) if found[0] is None else (int(found[0]), int(found[1]))

    def measure(ranges):
        counts = spark.read.jdbc(url, f"({counts_statement(spec, dialect, key, ranges, where)}) c", properties=options)
        return {int(r[0]): (int(r[1]), int(r[2]), int(r[3])) for r in counts.collect() if r[0] is not None}

    ranges = balanced_ranges(low, high, shards, measure) if balanced else pk_ranges(low, high, shards)
    predicates = range_predicates(quote_identifier(key, dialect), ranges)
    if not predicates:
        return spark.read.jdbc(url, table, properties=options)
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


# --- discovery -----------------------------------------------------------------------

# Base tables only, no views, no system tables, no partition children.
TABLE_LISTS = {
    "mysql": "SELECT table_schema AS schema_name, table_name FROM information_schema.tables "
    "WHERE table_type = 'BASE TABLE' AND table_schema = DATABASE()",
    "mssql": "SELECT table_schema AS schema_name, table_name FROM information_schema.tables "
    "WHERE table_type = 'BASE TABLE' AND table_schema NOT IN ('sys', 'INFORMATION_SCHEMA')",
    "pgsql": "SELECT n.nspname AS schema_name, c.relname AS table_name FROM pg_catalog.pg_class c "
    "JOIN pg_catalog.pg_namespace n ON n.oid = c.relnamespace "
    "WHERE c.relkind IN ('r', 'p') AND NOT c.relispartition "
    "AND n.nspname NOT IN ('pg_catalog', 'information_schema') AND n.nspname NOT LIKE 'pg_toast%'",
}


def list_jdbc_tables(spark: SparkSession, url: str, dialect: str, properties: dict | None = None) -> DataFrame:
    """(schema_name, table_name) of every base table, in order."""
    found = spark.read.jdbc(url, f"({TABLE_LISTS[dialect]}) t", properties=properties or {})
    return found.orderBy("schema_name", "table_name")


def normalize_spec(spec: TableSpec, dialect: str) -> TableSpec:
    """The same rule for the columns, keys and references of a table description."""
    if dialect != "mssql":
        return spec

    def lower(names):
        return tuple(n.lower() for n in names)

    return replace(
        spec,
        columns=tuple(replace(c, name=c.name.lower()) for c in spec.columns),
        keys=tuple(replace(k, columns=lower(k.columns)) for k in spec.keys),
        foreign_keys=tuple(
            replace(fk, columns=lower(fk.columns), parent_columns=lower(fk.parent_columns)) for fk in spec.foreign_keys
        ),
    )


def normalize_names(df: DataFrame, dialect: str) -> DataFrame:
    """SQL Server column names go to lower case; the other dialects keep theirs."""
    return df.toDF(*[c.lower() for c in df.columns]) if dialect == "mssql" else df
