"""SQLite files as a Spark data source.

Each task opens a file read-only and reads one range of row numbers, or of the first key column of a table
without them, so one large table and many files both spread over the cluster. Filters on columns go into the
statement, where they spare the transfer of rows; Spark evaluates them again. The files must lie on a file system
that is mounted on every executor.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sqlite3
import sys
from urllib.parse import quote as url_quote

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

from ..model import TableSpec
from ..operators.sharding import pk_ranges
from ..plans.rules import base_type

BATCH_ROWS = 10_000
FILTER_SETTING = "spark.sql.python.filterPushdown.enabled"
_NUMBER = re.compile(r"[+-]?[0-9]+(\.[0-9]*)?(e[+-]?[0-9]+)?", re.IGNORECASE)
MOST_VALUES = 500  # of a list of values that goes into a statement; SQLite takes some thousand

# Tasks get these classes by value, so executors need no copy of the package.
for _code in (__name__, pk_ranges.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_code])


def local_path(path: str) -> str:
    """``file:/x`` and ``file:///x`` as a plain path; other schemes cannot be opened by SQLite."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        raise ValueError(f"SQLite needs a mounted file system, not {path}")
    return path


def sqlite_files(path: str) -> list[str]:
    """The file itself, or every file of a directory or pattern, in order."""
    plain = local_path(path)
    found = glob.glob(os.path.join(plain, "*") if os.path.isdir(plain) else plain)
    return sorted(f for f in found if os.path.isfile(f) and not os.path.basename(f).startswith((".", "_")))


def open_read_only(file: str) -> sqlite3.Connection:
    connection = sqlite3.connect(f"file:{url_quote(file)}?mode=ro", uri=True)
    # Text that is not valid UTF-8 must not fail the scan.
    connection.text_factory = lambda raw: raw.decode("utf-8", "replace")
    return connection


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class RowidRange(InputPartition):
    """One of ``shards`` ranges of a file's rows; its bounds are looked up by the task that reads it."""

    def __init__(self, file: str, shard: int = 0, shards: int = 1):
        self.file, self.shard, self.shards = file, shard, shards


def row_identifier(connection: sqlite3.Connection, table: str) -> str | None:
    """A name of the row number that no column of the table hides; None if there is none."""
    try:
        names = {r[1].lower() for r in connection.execute(f"PRAGMA table_info({quoted(table)})")}
        free = next((n for n in ("rowid", "_rowid_", "oid") if n not in names), None)
        if free:
            connection.execute(f"SELECT {free} FROM {quoted(table)} LIMIT 1").fetchone()
        return free
    except sqlite3.OperationalError:  # a view, or a table without row numbers
        return None


def key_column(connection: sqlite3.Connection, table: str) -> str | None:
    """The first column of a primary key, if it holds numbers alone."""
    try:
        first = [r[1] for r in connection.execute(f"PRAGMA table_info({quoted(table)})") if r[5] == 1]
        if not first:
            return None
        # Numbers sort before texts and blobs, and after NULL: two look-ups in the key tell.
        name = quoted(first[0])
        ends = connection.execute(f"SELECT typeof(MIN({name})), typeof(MAX({name})) FROM {quoted(table)}").fetchone()
        return name if ends == ("integer", "integer") else None
    except sqlite3.OperationalError:
        return None


def affinities(connection: sqlite3.Connection, table: str) -> dict[str, str]:
    """What each column makes of the values put into it, by the rules for its declared type."""
    out = {}
    for row in connection.execute(f"PRAGMA table_info({quoted(table)})"):
        kind = (row[2] or "").upper()
        if "INT" in kind:
            out[row[1]] = "integer"
        elif any(word in kind for word in ("CHAR", "CLOB", "TEXT")):
            out[row[1]] = "text"
        elif not kind or "BLOB" in kind:
            out[row[1]] = "none"
        else:
            out[row[1]] = "number"
    return out


def pushed_condition(pushed: list[tuple], kinds: dict[str, str]) -> tuple[str, list]:
    """A condition that no row fails which Spark's filters on the cells' texts pass, and its parameters.

    A parameter takes the column's affinity, so an equality of texts is one of values. Order is that of texts in
    text columns alone. Cells that are blobs, or any in a column without affinity, are left to Spark.
    """
    terms, values = [], []
    for op, name, given in pushed:
        column, kind = quoted(name), kinds.get(name)
        if op in ("IS NULL", "IS NOT NULL"):
            terms.append(f"{column} {op}")
            continue
        if kind in (None, "none") or (op not in ("=", "IN") and kind != "text"):
            continue
        texts = given if op == "IN" else [given]
        if kind != "text" and not all(_NUMBER.fullmatch(t) for t in texts):
            continue  # infinity and the like are numbers to Python and texts to SQLite
        if op == "IN":
            test = f"{column} IN ({', '.join('?' * len(given))})"
            values += given
        elif op == "starts":
            test = f"substr({column}, 1, ?) = ? COLLATE BINARY"
            values += [len(given), given]
        else:
            test = f"{column} {op} ?" + (" COLLATE BINARY" if op != "=" else "")
            values.append(given)
        terms.append(f"({test} OR typeof({column}) = 'blob')")
    return " AND ".join(terms), values


def as_text(value):
    """Any stored value as text: a column's declared type does not bind its cells."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bytes):
        return value.decode("utf-8", "replace")
    return repr(value)


def as_bytes(value):
    return value if value is None or isinstance(value, bytes) else as_text(value).encode()


class SqliteReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.names = [f.name for f in schema.fields]
        self.blobs = [isinstance(f.dataType, T.BinaryType) for f in schema.fields]
        self.files = json.loads(options["files"])
        self.table = options["table"]
        self.shards = int(options.get("shards", "1"))

        self.pushed: list[tuple] = []

    def pushFilters(self, filters: list[Filter]):
        """Keeps what a statement can test; all filters stay with Spark, as a cell's text is made after the statement."""
        compared = {EqualTo: "=", EqualNullSafe: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        text = {n for n, blob in zip(self.names, self.blobs) if not blob}
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in self.names and isinstance(f, (IsNull, IsNotNull)):
                self.pushed.append(("IS NULL" if isinstance(f, IsNull) else "IS NOT NULL", name, None))
            elif name in text and type(f) in compared and isinstance(f.value, str):
                self.pushed.append((compared[type(f)], name, f.value))
            elif name in text and isinstance(f, In) and len(f.value) <= MOST_VALUES and all(isinstance(v, str) for v in f.value):
                self.pushed.append(("IN", name, list(f.value)))
            elif name in text and isinstance(f, StringStartsWith):
                self.pushed.append(("starts", name, f.value))
            yield f

    def partitions(self):
        return [RowidRange(f, k, self.shards) for f in self.files for k in range(max(1, self.shards))]

    def _range(self, connection, partition):
        """The part of the condition that selects a shard, with its bounds; None for a shard without rows."""
        if partition.shards <= 1:
            return "", []
        row = row_identifier(connection, self.table) or key_column(connection, self.table)
        if row is None:
            return ("", []) if partition.shard == 0 else None
        # Two index look-ups.
        low, high = (connection.execute(f"SELECT {f}({row}) FROM {quoted(self.table)}").fetchone()[0] for f in ("MIN", "MAX"))
        ranges = [r for r in pk_ranges(low, high, partition.shards) if r[0] < r[1]]
        if partition.shard >= len(ranges):
            return None
        first, end = ranges[partition.shard]
        if partition.shard == len(ranges) - 1:  # up to the greatest value, which may have none above it
            return f"{row} >= ? AND {row} <= ?", [first, end - 1]
        return f"{row} >= ? AND {row} < ?", [first, end]

    def statement(self, connection, partition) -> tuple[str, list] | None:
        """The statement that a task sends for a shard, with its parameters; None if the shard has no rows."""
        selected = self._range(connection, partition)
        if selected is None:
            return None
        condition, values = pushed_condition(self.pushed, affinities(connection, self.table)) if self.pushed else ("", [])
        where = " AND ".join(x for x in (selected[0], condition) if x)
        query = f"SELECT {', '.join(map(quoted, self.names))} FROM {quoted(self.table)}"
        return query + (f" WHERE {where}" if where else ""), [*selected[1], *values]

    def read(self, partition):
        import pyarrow as pa

        arrow_types = [pa.binary() if blob else pa.string() for blob in self.blobs]
        connection = open_read_only(partition.file)
        try:
            statement = self.statement(connection, partition)
            if statement is None:
                return
            cursor = connection.execute(*statement)
            while rows := cursor.fetchmany(BATCH_ROWS):
                arrays = [
                    pa.array([(as_bytes if blob else as_text)(v) for v in values], kind)
                    for values, blob, kind in zip(zip(*rows), self.blobs, arrow_types)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=self.names)
        finally:
            connection.close()


class SqliteDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def reader(self, schema: T.StructType) -> SqliteReader:
        return SqliteReader(schema, self.options)


def raw_schema(spec: TableSpec) -> T.StructType:
    """Blobs as binary, everything else as text: casting decides what a cell is worth."""
    return T.StructType(
        [
            T.StructField(
                c.name, T.BinaryType() if base_type(c.source_type).lower() == "blob" else T.StringType()
            )
            for c in spec.columns
        ]
    )


def read_sqlite_table(spark: SparkSession, path: str, spec: TableSpec, shards: int = 1) -> DataFrame:
    """Raw rows of one table from a file, a directory of files or a pattern.

    ``shards`` is the number of ranges per file, of row numbers or of the first key column. Filters on the columns are
    pushed into the statements, which is a session setting that this turns on. Bytes of a text that are not UTF-8
    come as U+FFFD.
    """
    files = sqlite_files(path)
    if not files:
        raise FileNotFoundError(path)
    spark.dataSource.register(SqliteDataSource)
    spark.conf.set(FILTER_SETTING, "true")
    return (
        spark.read.format("sqlite_table")
        .schema(raw_schema(spec))
        .option("files", json.dumps(files))
        .option("table", spec.name)
        .option("shards", str(shards))
        .load()
    )


def list_sqlite_tables(spark: SparkSession, path: str) -> DataFrame:
    """Names of the user tables of all files, in order; each file is opened by a task."""
    files = spark.createDataFrame([(f,) for f in sqlite_files(path)], "file string")

    def names(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            for file in batch.column("file").to_pylist():
                connection = open_read_only(file)
                try:
                    found += connection.execute(
                        "SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite\\_%' ESCAPE '\\'"
                    ).fetchall()
                finally:
                    connection.close()
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string())], ["table_name"])

    return files.mapInArrow(names, "table_name string").distinct().orderBy("table_name")
