"""Queries of rules, bounds, labels and versions that are held as tables, of file statistics and ordered lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..load import LoadOptions, load_table, read_loaded, table_path
from ..model import CastRule, ColumnSpec, KeySpec, TableSpec
from ..operators.agreement import compare_by_buckets, differing_keys
from ..operators.collect import collect_ordered, expand_ordered
from ..operators.labels import label_bounds, label_ranks, unknown_labels, with_rank
from ..operators.routing import bounds_from_text, default_from_text, route_by_bounds, route_by_values, values_from_text
from ..operators.rule_table import resolve_casts_table, rules_table
from ..publishing import published_versions, remove_old_versions
from ..session import scratch_dir
from ..sources.footers import counts_from_files, key_bounds_from_files
from ..sources.jdbc import normalize_names
from .checks import _ALTERED, _altered_orders, TABLES
from .registry import query, table

# --- agreement by buckets ------------------------------------------------------------


@query(_ALTERED + """
SELECT 'orders' AS "table", (SELECT count(*) FROM orders) AS src_rows, (SELECT count(*) FROM tgt) AS tgt_rows,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW') AS missing, 0::BIGINT AS extra,
       (SELECT count(*) FROM orders WHERE (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
                                       OR (o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')) AS changed
UNION ALL
SELECT 'orders, unchanged', count(*), count(*), 0, 0, 0 FROM orders
UNION ALL
SELECT 'orders, one in 500', count(*), count(*), 0, 0, count(*) FILTER (o_orderkey % 500 = 7) FROM orders
""", name="compare_by_buckets")
def compare_bucket_sums(spark, sf_dir):
    """A much altered copy, an equal one in another order, and one with few changes, whose other rows never move."""
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderkey") % 500 == 7, "?").otherwise(F.col("o_orderstatus"))
    few = orders.withColumn("o_orderstatus", status)
    out = compare_by_buckets(orders, _altered_orders(spark, sf_dir), ["o_orderkey"], "orders")
    out = out.unionByName(compare_by_buckets(orders, orders.repartition(5), ["o_orderkey"], "orders, unchanged"))
    return out.unionByName(compare_by_buckets(orders, few, ["o_orderkey"], "orders, one in 500"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 3 THEN 'missing' ELSE 'changed' END AS status
FROM orders WHERE o_orderkey % 997 = 3 OR o_orderkey % 991 = 5
""", name="differing_keys")
def differing_order_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderkey") % 991 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return differing_keys(orders, orders.filter("o_orderkey % 997 <> 3").withColumn("o_totalprice", price), ["o_orderkey"])


# --- versions ------------------------------------------------------------------------

PRICES = TableSpec("prices", (ColumnSpec("o_orderkey", "bigint(20)", nullable=False), ColumnSpec("o_totalprice", "decimal(15,2)")), keys=(KeySpec(("o_orderkey",), primary=True),))


@query("""
WITH o AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(15,2)) AS price FROM orders),
steps AS (
  SELECT 'first' AS step, 1 AS versions, count(*) AS n_rows, sum(price) AS total FROM o WHERE k % 2 = 0
  UNION ALL SELECT 'failed', 1, count(*), sum(price) FROM o WHERE k % 2 = 0
  UNION ALL SELECT 'second', 2, count(*), sum(price + 1) FROM o
  UNION ALL SELECT 'cleared', 1, count(*), sum(price + 1) FROM o)
SELECT step, versions, n_rows, CAST(total AS VARCHAR) AS total FROM steps
""")
def publish_versions(spark, sf_dir):
    """Loads of a table in versions: one that fails half-way leaves the rows before it, and old ones go when told to."""
    target = scratch_dir(spark, "versions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    options = LoadOptions(mode="drop_create", versioned=True, count_bytes=False)
    path, steps = table_path(target, PRICES), []

    def step(name):
        total = read_loaded(spark, target, PRICES).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("t")).first()
        steps.append((name, len(published_versions(spark, path)), total.n, str(total.t)))

    load_table(orders.filter("o_orderkey % 2 = 0"), PRICES, "mysql", target, options)
    step("first")
    bad = F.when(F.col("o_orderkey") == orders.agg(F.max("o_orderkey")).first()[0], F.raise_error(F.lit("the source broke off")))
    try:
        load_table(orders.repartition(4).withColumn("o_totalprice", F.coalesce(bad.cast("decimal(15,2)"), F.col("o_totalprice"))), PRICES, "mysql", target, options)
    except Exception as e:  # noqa: BLE001
        if "the source broke off" not in str(e):
            raise
    step("failed")
    load_table(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), PRICES, "mysql", target, options)
    step("second")
    remove_old_versions(spark, path)
    step("cleared")
    return spark.createDataFrame(steps, "step string, versions int, n_rows bigint, total string")


# --- rules as a table ----------------------------------------------------------------

TENANT_RULES = {
    "north": (
        CastRule("tinyint", "boolean", type_mod="(1)", drop_typemod=True, transform="tinyint-to-boolean"),
        CastRule("", "bigserial", auto_increment=True, drop_typemod=True),
        CastRule("varchar", "varchar($mod)"),
    ),
    "south": (
        CastRule("varchar", "text", drop_typemod=True),
        CastRule("tinyint", "smallint", drop_typemod=True),
    ),
}


@query("""
WITH c AS (
  SELECT p_partkey,
         CASE p_partkey % 3 WHEN 0 THEN 'north' WHEN 1 THEN 'south' ELSE 'west' END AS catalog,
         CASE p_partkey % 4 WHEN 0 THEN 'TINYINT(' || p_size || ')' WHEN 1 THEN 'varchar(' || p_size || ')' WHEN 2 THEN 'int(11) unsigned' ELSE 'Geometry' END AS column_type,
         CASE WHEN p_size % 2 = 0 THEN 'auto_increment' END AS extra, p_size, p_partkey % 4 AS kind
  FROM part)
SELECT p_partkey, catalog, column_type, extra,
       CASE WHEN catalog = 'north' AND kind = 0 AND p_size = 1 THEN 'boolean'
            WHEN catalog = 'north' AND p_size % 2 = 0 THEN 'bigserial'
            WHEN catalog = 'north' AND kind = 1 THEN 'varchar(' || p_size || ')'
            WHEN catalog = 'south' AND kind = 1 THEN 'text'
            WHEN catalog = 'south' AND kind = 0 THEN 'smallint'
            ELSE CASE kind WHEN 0 THEN 'tinyint' WHEN 1 THEN 'varchar' WHEN 2 THEN 'int' ELSE 'geometry' END END AS target_type,
       CASE WHEN catalog = 'north' THEN (kind = 0 AND p_size = 1) OR p_size % 2 = 0 WHEN catalog = 'south' THEN kind < 2 ELSE false END AS drop_typemod,
       CASE WHEN catalog = 'north' AND kind = 0 AND p_size = 1 THEN 'tinyint-to-boolean' END AS transform
FROM c
""", name="resolve_casts_table")
def resolve_tenant_casts(spark, sf_dir):
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    columns = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 3 == 0, "north").when(F.col("p_partkey") % 3 == 1, "south").otherwise("west").alias("catalog"),
        F.when(kind == 0, F.concat(F.lit("TINYINT("), size, F.lit(")")))
        .when(kind == 1, F.concat(F.lit("varchar("), size, F.lit(")")))
        .when(kind == 2, "int(11) unsigned")
        .otherwise("Geometry")
        .alias("column_type"),
        F.when(F.col("p_size") % 2 == 0, "auto_increment").alias("extra"),
    )
    return resolve_casts_table(columns, rules_table(spark, TENANT_RULES))


# --- bounds as a table ---------------------------------------------------------------


@query("""
WITH o AS (SELECT o_orderkey, year(o_orderdate) AS y, o_orderpriority AS p FROM orders)
SELECT CASE WHEN y < 1994 OR (y = 1994 AND p < '3-MEDIUM') THEN 'early'
            WHEN y < 1996 THEN 'middle'
            WHEN y = 1996 AND p >= '2-HIGH' AND p < '5-LOW' THEN 'part of 1996'
            WHEN y > 1996 AND y < 1998 THEN 'late' ELSE 'rest' END AS partition_name,
       count(*) AS n_rows, min(o_orderkey) AS low, max(o_orderkey) AS high
FROM o GROUP BY 1
""")
def route_ranges_of_two_columns(spark, sf_dir):
    """Ranges over a year and a segment, written as a PostgreSQL catalog gives them."""
    parts = spark.createDataFrame(
        [
            ("early", "FOR VALUES FROM (MINVALUE, MINVALUE) TO (1994, '3-MEDIUM')"),
            ("middle", "FOR VALUES FROM (1994, '3-MEDIUM') TO (1996, MINVALUE)"),
            ("part of 1996", "FOR VALUES FROM (1996, '2-HIGH') TO (1996, '5-LOW')"),
            ("late", "FOR VALUES FROM (1996, MAXVALUE) TO (1998, MINVALUE)"),
            ("rest", "DEFAULT"),
        ],
        "name string, bound string",
    )
    routed = route_by_bounds(table(spark, sf_dir, "orders"), ["year(o_orderdate)", "o_orderpriority"], bounds_from_text(parts), default_from_text(parts))
    return routed.groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


@query("""
WITH top AS (SELECT max(l_orderkey) AS m FROM lineitem),
edges AS (SELECT DISTINCT l_orderkey // (m // 5000 + 1) AS k FROM lineitem, top)
SELECT 'r' || (l_orderkey // (m // 5000 + 1)) AS partition_name, count(*) AS n_rows, min(l_orderkey) AS low, max(l_orderkey) AS high
FROM lineitem, top GROUP BY 1
""")
def route_many_ranges(spark, sf_dir):
    """Some 5,000 ranges that are made from the table's own keys."""
    rows = table(spark, sf_dir, "lineitem")
    low, high, _ = key_bounds_from_files(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey")
    width = high // 5_000 + 1
    begin = (F.col("id") * width).cast("string")
    end = ((F.col("id") + 1) * width).cast("string")
    bound = lambda c: F.array(F.struct(F.lit(0).alias("kind"), c.alias("value")))
    bounds = spark.range(low // width, high // width + 1).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("name"), bound(begin).alias("low"), bound(end).alias("high"))
    routed = route_by_bounds(rows, ["l_orderkey"], bounds)
    return routed.groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high"))


@query("""
SELECT CASE WHEN l_partkey % 3 = 0 THEN 'other' ELSE 'p' || (l_partkey % 7) END AS partition_name, count(*) AS n_rows, min(l_partkey) AS low, max(l_partkey) AS high
FROM lineitem GROUP BY 1
""")
def route_many_values(spark, sf_dir):
    """A list partition for two of three part keys, thousands of values in all."""
    keys = table(spark, sf_dir, "lineitem").select("l_partkey").distinct().filter("l_partkey % 3 <> 0")
    values = keys.select(F.concat(F.lit("p"), (F.col("l_partkey") % 7).cast("string")).alias("name"), F.col("l_partkey").cast("string").alias("value"))
    routed = route_by_values(table(spark, sf_dir, "lineitem"), "l_partkey", values, "other")
    return routed.groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"), F.min("l_partkey").alias("low"), F.max("l_partkey").alias("high"))


@query("""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'P' OR o_orderstatus IS NULL THEN 'open' ELSE 'rest' END AS partition_name, count(*) AS n_rows
FROM (SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders) GROUP BY 1
""")
def route_values_from_text(spark, sf_dir):
    parts = spark.createDataFrame([("done", "FOR VALUES IN ('F')"), ("open", "FOR VALUES IN ('P', NULL)"), ("rest", "DEFAULT")], "name string, bound string")
    orders = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    routed = route_by_values(orders, "o_orderstatus", values_from_text(parts), default_from_text(parts))
    return routed.groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"))


# --- labels --------------------------------------------------------------------------

PRIORITIES = ("5-LOW", "2-HIGH", "1-URGENT", "3-MEDIUM")


@query("""
WITH r AS (SELECT o_custkey, o_orderpriority AS p, list_position(['5-LOW', '2-HIGH', '1-URGENT', '3-MEDIUM'], o_orderpriority) AS rank FROM orders)
SELECT o_custkey, arg_min(p, rank) AS low, arg_max(p, rank) AS high, count(*) AS n_rows FROM r WHERE rank > 0 GROUP BY 1
""")
def enum_bounds(spark, sf_dir):
    """Least and greatest priority of each customer by the order in which the labels are declared."""
    return label_bounds(table(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES, ["o_custkey"])


@query("""
SELECT o_orderkey, o_orderpriority, CAST(row_number() OVER (ORDER BY rank NULLS LAST, o_orderkey) AS INTEGER) AS place
FROM (SELECT *, nullif(list_position(['5-LOW', '2-HIGH', '1-URGENT', '3-MEDIUM'], o_orderpriority), 0) AS rank FROM orders)
ORDER BY place LIMIT 100
""")
def enum_order(spark, sf_dir):
    """The first hundred orders by declared order of their priority."""
    from pyspark.sql import Window

    first = with_rank(table(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES).orderBy(F.col("rank").asc_nulls_last(), "o_orderkey").limit(100)
    place = F.row_number().over(Window.orderBy(F.col("rank").asc_nulls_last(), "o_orderkey"))
    return first.select("o_orderkey", "o_orderpriority", place.alias("place"))


@query("""
SELECT 'k' || l_orderkey % 75000 AS value, count(*) AS n_rows FROM lineitem WHERE l_orderkey % 75000 >= 50000 OR l_orderkey % 75000 < 10 GROUP BY 1
""")
def enum_long_list(spark, sf_dir):
    """An enum of some 50,000 labels, held as a table and met by a hash anti join."""
    labels = spark.range(10, 50_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("label"), F.col("id").cast("int").alias("rank"))
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("k"), (F.col("l_orderkey") % 75_000).cast("string")).alias("k"))
    return unknown_labels(rows, "k", labels)


# --- lists, files, names -------------------------------------------------------------


@query("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, min(l_partkey) AS part, min(l_suppkey) AS supplier FROM lineitem GROUP BY 1, 2", name="expand_ordered")
def expand_line_parts(spark, sf_dir):
    """Blocks of ordered lists, two arrays side by side, back to the rows that they were made of."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.struct(F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supplier")).alias("v"))
    lists = collect_ordered(rows, ["l_orderkey"], "v", "l_linenumber", block=3, positions=True)
    arrays = lists.select("l_orderkey", "block", "positions", F.col("values.part").alias("part"), F.col("values.supplier").alias("supplier"))
    return expand_ordered(arrays, ["l_orderkey"], ["part", "supplier"], "l_linenumber", block=3)


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in TABLES))
def table_counts_from_footers(spark, sf_dir):
    return counts_from_files(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES})


@query("""
SELECT 'l_orderkey' AS "column", min(l_orderkey) AS low, max(l_orderkey) AS high, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'o_custkey', min(o_custkey), max(o_custkey), count(*) FROM orders
UNION ALL SELECT 'event_id', min(event_id), max(event_id), count(*) FROM events
""")
def key_bounds_from_footers(spark, sf_dir):
    rows = [(c, *key_bounds_from_files(spark, f"{sf_dir}/{t}.parquet", c)) for t, c in (("lineitem", "l_orderkey"), ("orders", "o_custkey"), ("events", "event_id"))]
    return spark.createDataFrame(rows, "column string, low bigint, high bigint, n_rows bigint")


@query("""
SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'even' ELSE 'odd' END AS kind, count(*) AS n_rows, CAST(sum(s_nationkey) AS BIGINT) AS total FROM supplier GROUP BY 1
""", name="normalize_names")
def normalize_mixed_case(spark, sf_dir):
    """Columns in mixed case, as SQL Server hands them over, under their target's names."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("SuppKey"), F.col("s_nationkey").alias("NationKEY"))
    named = normalize_names(rows, "mssql")
    assert named.columns == ["suppkey", "nationkey"]
    kind = F.when(named["suppkey"] % 2 == 0, "even").otherwise("odd").alias("kind")
    return named.groupBy(kind).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("nationkey").cast("bigint").alias("total"))
