"""Queries of the readers and writers: each writes the given tables and reads them back."""

from __future__ import annotations

import os
import sqlite3

from pyspark.sql import functions as F

from ..functions.text import quote
from ..model import ColumnSpec, KeySpec, PartitionSpec, TableSpec
from ..operators.casting import ERRORS, cast_table
from ..operators.partitioning import route_partition
from ..operators.sharding import balanced_ranges, key_bounds, measure_ranges, pk_ranges, shard_by_pk, shard_predicates
from ..operators.skew import stored
from ..session import scratch_dir, session_conf
from ..sinks import encode_copy_text, write_copy_text, write_partitioned, write_table
from ..sources.copytext import CORRUPT, read_copy_text
from ..sources.delimited import profile_delimited, read_delimited
from ..sources.sqlite import local_path, read_sqlite_table
from ..sources.tables import materialize_views, select_tables
from .registry import query, table

CUSTOMER = TableSpec(
    "customer",
    (
        ColumnSpec("c_custkey", "integer", nullable=False),
        ColumnSpec("c_name", "VARCHAR(25)"),
        ColumnSpec("c_nationkey", "int"),
        ColumnSpec("c_acctbal", "decimal(15,2)"),
        ColumnSpec("c_mktsegment", "text"),
    ),
    keys=(KeySpec(("c_custkey",), primary=True),),
)

CUSTOMER_SQL = """
SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal, c_mktsegment FROM customer
"""


def customer_text(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    return rows.select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)").alias("c_acctbal"), "c_mktsegment"
    )


def cast_customer(raw):
    out = cast_table(raw.select(*CUSTOMER.column_names), CUSTOMER.columns, "sqlite")
    return out.filter(F.col(ERRORS).isNull()).drop(ERRORS)


# --- delimited -----------------------------------------------------------------------


@query(CUSTOMER_SQL)
def delimited_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "delimited")
    customer_text(spark, sf_dir).write.option("header", "true").option("sep", "|").csv(path)
    return cast_customer(read_delimited(spark, path, delimiter="|", header=True))


@query("""
SELECT doc_id, lang, length(t) AS n, md5(t) AS digest
FROM (SELECT doc_id, lang, 'x' || chr(13) || replace(text, 'e ', 'e' || chr(13)) || '"' || chr(10) || chr(10) || '#y' AS t FROM documents)
""")
def delimited_multiline(spark, sf_dir):
    """Newlines, empty lines, bare carriage returns, quotes, delimiters and comment signs inside quoted text."""
    path = scratch_dir(spark, "multiline")
    text = F.concat(F.lit("x\r"), F.replace("text", F.lit("e "), F.lit("e\r")), F.lit('"\n\n#y'))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
    docs = table(spark, sf_dir, "documents").select(F.concat_ws(",", quoted(F.col("doc_id")), quoted(F.col("lang")), quoted(text)).alias("value"))
    docs.write.text(path)
    back = read_delimited(spark, path, columns=["doc_id", "lang", "text"], comment="#", keep_empty=True, trim=False)
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.length("text").cast("bigint").alias("n"), F.md5("text").alias("digest")
    )


@query(CUSTOMER_SQL)
def delimited_skip(spark, sf_dir):
    """Each file opens with two lines of remarks, one of them ragged, and a header."""
    path = scratch_dir(spark, "skip")
    rows = customer_text(spark, sf_dir)
    head = ["exported customers", "one,two", ",".join(rows.columns)]
    fields = [F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')) for c in rows.columns]
    lines = rows.select(F.concat_ws(",", *fields).alias("value"))
    written_lines(lines, head).text(path)
    return cast_customer(read_delimited(spark, path, skip_records=2, header=True))


def written_lines(rows, head):
    """The frame's lines, every file opening with the lines of ``head``."""

    def with_head(batches):
        import pyarrow as pa

        for i, batch in enumerate(batches):
            if i == 0:
                yield pa.RecordBatch.from_pydict({"value": head}, schema=batch.schema)
            yield batch

    return rows.mapInArrow(with_head, "value string").write


@query(CUSTOMER_SQL)
def delimited_comments(spark, sf_dir):
    """Each file opens with 150 comment lines, a record of remarks over 150 lines, and a header."""
    path = scratch_dir(spark, "comments")
    rows = customer_text(spark, sf_dir)
    remark = ['"remark', *[f"line {i}, still quoted" for i in range(148)], '# the end"']
    head = [*[f"# {i}" for i in range(150)], *remark, ",".join(rows.columns)]
    lines = rows.select(F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns]).alias("value"))
    written_lines(lines, head).text(path)
    return cast_customer(read_delimited(spark, path, comment="#", skip_records=1, header=True))


@query(CUSTOMER_SQL)
def delimited_skip_splits(spark, sf_dir):
    """Two thousand records to skip in each file, which is read in splits that hold far fewer."""
    path = scratch_dir(spark, "skip-splits")
    rows = customer_text(spark, sf_dir)
    head = [f"skipped {i}" for i in range(2000)] + [",".join(rows.columns)]
    lines = rows.select(F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns]).alias("value"))
    written_lines(lines, head).text(path)
    with session_conf(spark, spark__sql__files__maxPartitionBytes="8192", spark__sql__files__openCostInBytes="0"):
        read = cast_customer(read_delimited(spark, path, skip_records=2000, header=True))
        return stored(read, "skip-splits-read")


@query("""
SELECT c_mktsegment, count(*) FILTER (c_custkey % 7 <> 3) AS whole, count(*) FILTER (c_custkey % 7 = 3) AS broken
FROM customer GROUP BY c_mktsegment
""")
def delimited_broken_quotes(spark, sf_dir):
    """Quotes that stay open or stand within a field: each such line is a reject, and no other."""
    path = scratch_dir(spark, "broken-quotes")
    broken = F.get(F.array(F.lit(',"open'), F.lit(',mid"dle'), F.lit(',"closed"early')), F.pmod("c_custkey", F.lit(3)).cast("int"))
    line = F.concat("c_mktsegment", F.when(F.col("c_custkey") % 7 == 3, broken).otherwise(',"all ""right"""'))
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    rows = read_delimited(spark, path, columns=["segment", "note"], on_ragged="reject", multiline=False)
    segment = F.coalesce("segment", F.split(CORRUPT, ",")[0])
    return rows.groupBy(segment.alias("c_mktsegment")).agg(
        F.count_if(F.col("note") == 'all "right"').alias("whole"), F.count_if(F.col(CORRUPT).isNotNull()).alias("broken")
    )


@query("""
SELECT c_mktsegment, count(*) FILTER (c_custkey % 19 <> 4) AS whole, count(*) FILTER (c_custkey % 19 = 4) AS ragged
FROM customer GROUP BY c_mktsegment
""")
def delimited_ragged(spark, sf_dir):
    path = scratch_dir(spark, "ragged")
    extra = F.when(F.col("c_custkey") % 19 == 4, ",surplus").otherwise("")
    line = F.concat("c_mktsegment", F.lit(","), F.col("c_custkey").cast("string"), extra)
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    rows = read_delimited(spark, path, columns=["segment", "key"], on_ragged="reject")
    segment = F.coalesce("segment", F.split(CORRUPT, ",")[0])
    return rows.groupBy(segment.alias("c_mktsegment")).agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("whole"), F.count_if(F.col(CORRUPT).isNotNull()).alias("ragged")
    )


@query("""
SELECT c_nationkey AS nation,
       CASE c_nationkey % 5 WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN '|' WHEN 3 THEN chr(9) ELSE '^' END AS delimiter,
       false AS header, 4 AS n_cols
FROM customer GROUP BY c_nationkey
""", name="profile_delimited")
def profile_files(spark, sf_dir):
    path = scratch_dir(spark, "profile")
    rows = customer_text(spark, sf_dir)
    signs = F.array(*[F.lit(d) for d in (",", ";", "|", "\t", "^")])
    line = F.array_join(
        F.array(F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string"), "c_mktsegment"), "\u0001"
    )
    lines = rows.select("c_nationkey", F.replace(line, F.lit("\u0001"), F.get(signs, F.col("c_nationkey") % 5)).alias("value"))
    lines.write.partitionBy("c_nationkey").text(path)
    nation = F.regexp_extract("file", "c_nationkey=([0-9]+)", 1).cast("int")
    return profile_delimited(spark, path).select(nation.alias("nation"), "delimiter", "header", "n_cols").distinct()


# --- COPY text -----------------------------------------------------------------------

COPY_DOCUMENTS_SQL = """
WITH escaped AS (
  SELECT doc_id, lang || chr(9) || doc_id || chr(9) ||
         replace(replace(replace(replace(replace(replace(replace(text,
           '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t'), chr(8), '\\b'), chr(12), '\\f'), chr(11), '\\v')
         || chr(9) || CASE WHEN n_chars > 500 THEN 't' ELSE 'f' END || chr(9) ||
         CASE WHEN source = 'web' THEN '\\N' ELSE source END AS line
  FROM documents)
SELECT split_part(line, chr(9), 2) AS doc_id, strlen(line) AS n_bytes, md5(line) AS digest FROM escaped
"""


def documents_row(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "lang",
        "doc_id",
        "text",
        (F.col("n_chars") > 500).alias("long"),
        F.when(F.col("source") != "web", F.col("source")).alias("source"),
    )


@query(COPY_DOCUMENTS_SQL)
def copy_text_encode(spark, sf_dir):
    lines = encode_copy_text(documents_row(spark, sf_dir))
    return lines.select(
        F.split_part("value", F.lit("\t"), F.lit(2)).alias("doc_id"),
        F.octet_length("value").cast("bigint").alias("n_bytes"),
        F.md5("value").alias("digest"),
    )


@query("""
SELECT doc_id, lang, md5(text) AS digest, n_chars > 500 AS long, CASE WHEN source = 'web' THEN NULL ELSE source END AS source
FROM documents
""")
def copy_text_roundtrip(spark, sf_dir):
    data = write_copy_text(documents_row(spark, sf_dir), scratch_dir(spark, "copy"), "public.documents")
    raw = read_copy_text(spark, data, ["lang", "doc_id", "text", "long", "source"])
    columns = (
        ColumnSpec("doc_id", "bigint", nullable=False),
        ColumnSpec("lang", "text"),
        ColumnSpec("text", "text", nullable=False),
        ColumnSpec("long", "boolean"),
        ColumnSpec("source", "text"),
    )
    back = cast_table(raw, columns, "pgsql", on_error="fail")
    return back.select("doc_id", "lang", F.md5("text").alias("digest"), "long", "source")


@query("""
SELECT o_orderkey, o_orderkey || chr(9) || o_custkey || chr(9) || o_orderstatus || chr(9) ||
       CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) || chr(9) || strftime(o_orderdate, '%Y-%m-%d') || chr(9) ||
       lower('\\\\x') || lower(hex(encode(o_orderpriority))) AS line
FROM orders
""")
def copy_text_typed(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.encode("o_orderpriority", "UTF-8").alias("priority"),
    )
    lines = encode_copy_text(rows)
    return lines.select(F.split_part("value", F.lit("\t"), F.lit(1)).cast("bigint").alias("o_orderkey"), F.col("value").alias("line"))


# --- shards --------------------------------------------------------------------------


@query("""
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi, greatest(1, (max(o_orderkey) - min(o_orderkey)) // 8) AS w FROM orders),
s AS (SELECT least((o_orderkey - lo) // w, 7) AS shard_id, count(*) AS n_rows FROM orders, b GROUP BY 1)
SELECT shard_id, lo + shard_id * w AS low, CASE WHEN shard_id = 7 THEN hi + 1 ELSE lo + (shard_id + 1) * w END AS high, n_rows
FROM s, b
""")
def pk_range_shards(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    low, high = key_bounds(orders, "o_orderkey")
    ranges = pk_ranges(low, high, 8)
    counts = shard_by_pk(orders, "o_orderkey", 8, (low, high)).groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_rows"))

    def bound(side):
        return F.get(F.array(*[F.lit(r[side]).cast("bigint") for r in ranges]), F.col("shard_id").cast("int"))

    return counts.select("shard_id", bound(0).alias("low"), bound(1).alias("high"), "n_rows")


@query("""
WITH b AS (SELECT min(s_suppkey) AS lo, greatest(1, (max(s_suppkey) - min(s_suppkey)) // 4) AS w FROM supplier)
SELECT least((s_suppkey - lo) // w, 3) AS shard, count(*) AS n_rows, min(s_suppkey) AS low, max(s_suppkey) AS high
FROM supplier, b GROUP BY 1
""")
def jdbc_shard_predicates(spark, sf_dir):
    """The predicates a sharded JDBC scan sends, run over the table itself."""
    supplier = table(spark, sf_dir, "supplier")
    shard = None
    for i, predicate in enumerate(shard_predicates(quote("s_suppkey"), *key_bounds(supplier, "s_suppkey"), 4)):
        hit = F.expr(predicate)
        number = F.lit(i).cast("bigint")
        shard = F.when(hit, number) if shard is None else shard.when(hit, number)
    return supplier.groupBy(shard.alias("shard")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("s_suppkey").alias("low"), F.max("s_suppkey").alias("high")
    )


@query("""
SELECT count(*) AS n_rows, 0::BIGINT AS crowded_ranges, CAST(min(k * k) AS VARCHAR) AS low, CAST(max(k * k) AS VARCHAR) AS high
FROM (SELECT CAST(o_orderkey AS HUGEINT) AS k FROM orders)
""")
def pk_balanced_shards(spark, sf_dir):
    """Keys that thin out towards the top: no range may hold more than twice its share."""
    key = F.col("o_orderkey").cast("decimal(19,0)")
    orders = table(spark, sf_dir, "orders").select((key * key).cast("decimal(38,0)").alias("k"))
    ranges = balanced_ranges(*key_bounds(orders, "k"), 8, measure_ranges(orders, "k"))
    spec = PartitionSpec("range", "k", tuple((f"s{i}", lo, hi) for i, (lo, hi) in enumerate(ranges)))
    per_range = route_partition(orders, spec).groupBy("partition_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")
    )
    totals = per_range.filter("partition_name IS NOT NULL").agg(
        F.sum("n").alias("n_rows"), F.collect_list("n").alias("sizes"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    # There are a few dozen ranges at most, so their sizes fit in one list.
    crowded = F.size(F.filter("sizes", lambda n: n > F.ceil(F.col("n_rows") / 4))).cast("bigint")
    return totals.select("n_rows", crowded.alias("crowded_ranges"), F.col("low").cast("string").alias("low"), F.col("high").cast("string").alias("high"))


# --- SQLite --------------------------------------------------------------------------


FILE_ROWS = 200_000


def write_sqlite_parts(df, spec: TableSpec, folder: str, without_rowid: bool = False):
    """Every partition as SQLite files of at most ``FILE_ROWS`` rows; returns files and rows.

    A file is built in memory and appears under its final name in one step, so a task
    that is run again just replaces it.
    """
    types = {"c_custkey": "integer primary key", "c_nationkey": "int"}
    columns = ", ".join(f'"{c.name}" {types.get(c.name, c.source_type)}' for c in spec.columns)
    key = ", ".join(f'"{c}"' for c in spec.primary_key)
    body = f"({columns}, PRIMARY KEY ({key})) WITHOUT ROWID" if without_rowid else f"({columns})"
    marks = ", ".join("?" for _ in spec.columns)
    name, limit = spec.name, FILE_ROWS

    def build(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        os.makedirs(folder, exist_ok=True)

        def empty():
            connection = sqlite3.connect(":memory:")
            connection.execute(f'CREATE TABLE "{name}" {body}')
            return connection

        def save(connection, number):
            connection.commit()
            part = f"part-{context.partitionId():05d}-{number:04d}.db"
            draft = os.path.join(folder, f".{part}-{context.taskAttemptId()}")
            with open(draft, "wb") as f:
                f.write(connection.serialize())
            connection.close()
            os.replace(draft, os.path.join(folder, part))

        connection, rows, number = empty(), 0, 0
        for batch in batches:
            connection.executemany(f'INSERT INTO "{name}" VALUES ({marks})', zip(*[c.to_pylist() for c in batch.columns]))
            rows += batch.num_rows
            if rows >= limit:
                save(connection, number)
                yield pa.RecordBatch.from_pydict({"n_rows": [rows]})
                connection, rows, number = empty(), 0, number + 1
        if rows:
            save(connection, number)
            yield pa.RecordBatch.from_pydict({"n_rows": [rows]})

    return df.mapInArrow(build, "n_rows bigint").agg(F.count(F.lit(1)), F.sum("n_rows")).first()


@query(CUSTOMER_SQL)
def sqlite_scan(spark, sf_dir):
    folder = local_path(scratch_dir(spark, "sqlite"))
    rows = customer_text(spark, sf_dir).withColumn("c_acctbal", F.col("c_acctbal").cast("string"))
    write_sqlite_parts(rows, CUSTOMER, folder)
    return cast_customer(read_sqlite_table(spark, folder, CUSTOMER, shards=3))


@query("""
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus IN ('F', 'P') AND o_orderkey >= 100
""")
def sqlite_filtered_scan(spark, sf_dir):
    """A table without row numbers, cut by its key into shards, whose filters reach the files."""
    folder = local_path(scratch_dir(spark, "sqlite-keys"))
    spec = TableSpec(
        "keyed",
        (ColumnSpec("o_orderkey", "INTEGER", nullable=False), ColumnSpec("o_orderpriority", "TEXT"), ColumnSpec("o_orderstatus", "TEXT")),
        keys=(KeySpec(("o_orderkey",), primary=True),),
    )
    rows = table(spark, sf_dir, "orders").select(*[F.col(c).cast("string").alias(c) for c in spec.column_names])
    write_sqlite_parts(rows, spec, folder, without_rowid=True)
    raw = read_sqlite_table(spark, folder, spec, shards=3)
    wanted = raw.filter((F.col("o_orderpriority") == "2-HIGH") & F.col("o_orderstatus").isin("F", "P"))
    out = cast_table(wanted, spec.columns, "sqlite")
    return out.filter(F.col(ERRORS).isNull() & (F.col("o_orderkey") >= 100)).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderpriority", "o_orderstatus"
    )


# --- table selection, views, load modes ----------------------------------------------


@query("""
SELECT c_name AS table_name FROM customer
WHERE (regexp_matches(c_name, '0[13]5') OR c_name ILIKE 'customer#%7' OR lower(c_name) = 'customer#000000012')
  AND NOT (c_name ILIKE 'customer#%_07' OR regexp_matches(c_name, '33'))
""", name="select_tables")
def select_table_names(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("table_name"))
    return select_tables(
        names, ["~/0[13]5/", "'customer#%7'", "CUSTOMER#000000012"], ["customer#%_07", "~/33/"]
    )


@query("""
SELECT c_mktsegment, o_orderstatus, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
""")
def materialize_view(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    view = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_mktsegment", "o_orderstatus", F.col("o_totalprice").cast("decimal(15,2)").alias("price")
    )
    view.createOrReplaceTempView("sparkload_order_segments")
    stored = materialize_views(spark, ["sparkload_order_segments"], scratch_dir(spark, "views"))
    rows = stored["sparkload_order_segments"]
    return rows.groupBy("c_mktsegment", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(38,2)").alias("price")
    )


@query("""
SELECT p_brand, 2 * count(*) AS n, CAST(2 * sum(p_size) AS BIGINT) AS size FROM part GROUP BY p_brand
""")
def load_modes(spark, sf_dir):
    target = scratch_dir(spark, "modes")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    write_table(part, target, "create", schema_only=True)
    write_table(part, target, "append")
    write_table(part.select("p_size", "p_brand", "p_partkey"), target, "truncate")
    write_table(part, target, "append")
    return spark.read.parquet(target).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size")
    )


# --- partitioned targets -------------------------------------------------------------


def _order_years(default=None):
    years = tuple((f"y{y}", f"{y}-01-01", f"{y + 1}-01-01") for y in range(1993, 2000))
    return PartitionSpec("range", "date_format(o_orderdate, 'yyyy-MM-dd')", years, default=default)


@query("""
SELECT CASE WHEN year(o_orderdate) BETWEEN 1993 AND 1999 THEN 'y' || year(o_orderdate) ELSE 'other' END AS partition_name,
       count(*) AS n_rows, min(o_orderkey) AS low, max(o_orderkey) AS high
FROM orders GROUP BY 1
""")
def route_partition_range(spark, sf_dir):
    path = scratch_dir(spark, "ranges")
    write_partitioned(table(spark, sf_dir, "orders"), _order_years(default="other"), path)
    return spark.read.parquet(path).groupBy("partition_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")
    )


@query("""
SELECT o_orderkey, o_orderstatus FROM orders WHERE year(o_orderdate) NOT BETWEEN 1993 AND 1999
""")
def unrouted_range_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return write_partitioned(rows, _order_years(), scratch_dir(spark, "unrouted")).drop("o_orderdate")


@query("""
SELECT CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'industry' WHEN c_mktsegment = 'BUILDING' THEN 'building'
       ELSE 'rest' END AS partition_name, count(*) AS n_rows
FROM customer GROUP BY 1
""")
def route_partition_list(spark, sf_dir):
    spec = PartitionSpec(
        "list", "c_mktsegment", (("industry", ("AUTOMOBILE", "MACHINERY")), ("building", ("BUILDING",))), default="rest"
    )
    path = scratch_dir(spark, "lists")
    write_partitioned(table(spark, sf_dir, "customer"), spec, path)
    return spark.read.parquet(path).groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
SELECT count(DISTINCT l_partkey) AS n_keys, 1 AS partitions_per_key, count(*) AS n_rows FROM lineitem
""")
def route_partition_hash(spark, sf_dir):
    """Names depend on the hash function; that a key has one partition does not."""
    path = scratch_dir(spark, "hashes")
    write_partitioned(table(spark, sf_dir, "lineitem"), PartitionSpec("hash", "l_partkey", modulus=6), path)
    keys = spark.read.parquet(path).groupBy("l_partkey").agg(
        F.count_distinct("partition_name").cast("int").alias("p"), F.count(F.lit(1)).alias("n")
    )
    return keys.agg(
        F.count(F.lit(1)).alias("n_keys"), F.max("p").alias("partitions_per_key"), F.sum("n").alias("n_rows")
    )
