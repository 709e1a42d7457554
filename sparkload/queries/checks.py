"""Queries of the integrity checks, comparisons and ordered lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import ForeignKeySpec, KeySpec
from ..operators import integrity as ig
from ..operators.collect import collect_ordered
from ..operators.compare import compare_tables, row_difference, table_counts
from .registry import query, table

# --- keys ----------------------------------------------------------------------------


@query("""
SELECT l_orderkey, line, count(*) AS n_rows,
       CASE WHEN line IS NULL THEN 'null key' ELSE 'duplicate key' END AS reason
FROM (SELECT l_orderkey, CASE WHEN l_quantity = 50 THEN NULL ELSE l_linenumber END AS line FROM lineitem)
GROUP BY l_orderkey, line HAVING line IS NULL OR count(*) > 1
""")
def pk_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_quantity") != 50, F.col("l_linenumber")).alias("line")
    )
    return ig.key_violations(rows, ["l_orderkey", "line"], primary=True)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1
""")
def pk_violation_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ig.key_violation_rows(rows, ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_custkey, o_orderpriority, count(*) AS n_rows, 'duplicate key' AS reason
FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1
""")
def filtered_unique(spark, sf_dir):
    key = KeySpec(("o_custkey", "o_orderpriority"), predicate="o_orderstatus = 'F'")
    return ig.check_key(table(spark, sf_dir, "orders"), key)


# --- references ----------------------------------------------------------------------


def _orders_with_strays(spark, sf_dir):
    """Orders whose customer key is NULL for one priority and out of range at fixed keys."""
    stray = F.when(F.col("o_orderpriority") == "5-LOW", None).when(
        F.col("o_orderkey") % 31 == 2, -F.col("o_custkey") - 1
    )
    return table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise(F.coalesce(stray, F.col("o_custkey")))
    )


_STRAYS = """
WITH child AS (
  SELECT * REPLACE (CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderkey % 31 = 2 THEN -o_custkey - 1
                    ELSE o_custkey END AS o_custkey) FROM orders)
"""

ORDER_CUSTOMER = ForeignKeySpec(("o_custkey",), "customer", ("c_custkey",))


@query(_STRAYS + """
SELECT o_custkey, count(*) AS n_rows, 'no parent' AS reason FROM child
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey) GROUP BY o_custkey
""")
def fk_orphans(spark, sf_dir):
    return ig.fk_orphans(_orders_with_strays(spark, sf_dir), table(spark, sf_dir, "customer"), ORDER_CUSTOMER)


@query(_STRAYS + """
SELECT o_orderkey, o_custkey, o_orderstatus FROM child
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
""")
def fk_orphan_rows(spark, sf_dir):
    child = _orders_with_strays(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus")
    return ig.fk_orphan_rows(child, table(spark, sf_dir, "customer"), ORDER_CUSTOMER)


@query("""
SELECT l_partkey, l_suppkey, count(*) AS n_rows, 'no parent' AS reason FROM lineitem c
WHERE NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_returnflag <> 'R' AND p.l_partkey = c.l_partkey AND p.l_suppkey = c.l_suppkey)
GROUP BY l_partkey, l_suppkey
""")
def fk_composite_orphans(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    parent = lines.filter(F.col("l_returnflag") != "R").select(
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp")
    )
    return ig.fk_orphans(lines, parent, ForeignKeySpec(("l_partkey", "l_suppkey"), "pairs", ("part", "supp")))


@query("""
SELECT part, l_suppkey, count(*) AS n_rows, CASE WHEN part IS NULL THEN 'partly null key' ELSE 'no parent' END AS reason
FROM (SELECT CASE WHEN l_quantity > 40 THEN NULL ELSE l_partkey END AS part, l_suppkey FROM lineitem) c
WHERE part IS NULL
   OR NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_linestatus = 'O' AND p.l_partkey = c.part AND p.l_suppkey = c.l_suppkey)
GROUP BY part, l_suppkey
""")
def fk_match_full(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    child = lines.select(F.when(F.col("l_quantity") <= 40, F.col("l_partkey")).alias("part"), "l_suppkey")
    parent = lines.filter(F.col("l_linestatus") == "O").select(F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))
    fk = ForeignKeySpec(("part", "l_suppkey"), "pairs", ("p", "s"), match="full")
    return ig.fk_orphans(child, parent, fk)


@query(_STRAYS + """
SELECT o_orderkey, o_custkey, c_custkey, c_name, c_mktsegment FROM child JOIN customer ON c_custkey = o_custkey
""")
def child_parent_join(spark, sf_dir):
    child = _orders_with_strays(spark, sf_dir).select("o_orderkey", "o_custkey")
    parent = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return ig.child_parent_join(child, parent, ORDER_CUSTOMER)


# --- values --------------------------------------------------------------------------


@query("""
SELECT * FROM (
  SELECT 'value' AS "column", count(*) FILTER (event_type = 'error') AS n_nulls FROM events
  UNION ALL SELECT 'user_id', count(*) FILTER (event_id % 7 = 1) FROM events) WHERE n_nulls > 0
""")
def null_violations(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_id") % 7 != 1, F.col("user_id")).alias("user_id"),
        "props",
    )
    return ig.null_violations(events, events.columns)


@query("""
SELECT o_orderpriority AS value, count(*) AS n_rows FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1
""")
def enum_violations(spark, sf_dir):
    return ig.enum_violations(table(spark, sf_dir, "orders"), "o_orderpriority", ("1-URGENT", "2-HIGH", "3-MEDIUM"))


@query("""
SELECT 'o_orderkey' AS "column", max(o_orderkey) AS last_value, max(o_orderkey) + 1 AS next_value FROM orders
UNION ALL SELECT 'o_custkey', max(o_custkey), max(o_custkey) + 1 FROM orders
UNION ALL SELECT 'unused', 1, 2
""")
def sequence_state(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("unused", F.lit(None).cast("bigint"))
    return ig.sequence_state(orders, ["o_orderkey", "o_custkey", "unused"])


# --- comparison ----------------------------------------------------------------------

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(" UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in TABLES), name="table_counts")
def count_tables(spark, sf_dir):
    return table_counts({t: table(spark, sf_dir, t) for t in TABLES})


def _altered_orders(spark, sf_dir):
    """A copy of orders that lost its low open orders, doubled the high ones, and changed urgent ones."""
    orders = table(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    lost = (status == "O") & (priority == "5-LOW")
    doubled = (status == "O") & (priority == "2-HIGH")
    changed = (status == "F") & (priority == "1-URGENT")
    copies = F.array_repeat(F.lit(1), F.when(lost, 0).when(doubled, 2).otherwise(1))
    return orders.select(
        *[c for c in orders.columns if c != "o_orderstatus"],
        F.when(changed, "X").otherwise(status).alias("o_orderstatus"),
        F.explode(copies).alias("copy"),
    ).select(*orders.columns)


_ALTERED = """
WITH tgt AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus)
  FROM orders WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')
  UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')
"""

_COMPARED = _ALTERED + """
SELECT 'orders' AS "table", (SELECT count(*) FROM orders) AS src_rows, (SELECT count(*) FROM tgt) AS tgt_rows,
       (SELECT count(*) FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM tgt)) AS missing,
       (SELECT count(*) FROM (SELECT * FROM tgt EXCEPT ALL SELECT * FROM orders)) AS extra
"""


@query(_COMPARED, name="compare_tables")
def compare_rows(spark, sf_dir):
    return compare_tables(table(spark, sf_dir, "orders"), _altered_orders(spark, sf_dir), table="orders")


@query(_COMPARED)
def compare_fingerprints(spark, sf_dir):
    src, tgt = table(spark, sf_dir, "orders"), _altered_orders(spark, sf_dir)
    return compare_tables(src, tgt, table="orders", by_fingerprint=True)


@query(_ALTERED + """
SELECT 'orders' AS "table", (SELECT count(*) FROM orders) AS src_rows, (SELECT count(*) FROM tgt) AS tgt_rows,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW') AS missing, 0::BIGINT AS extra,
       (SELECT count(*) FROM orders WHERE (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
                                       OR (o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')) AS changed
""")
def compare_by_key(spark, sf_dir):
    return compare_tables(
        table(spark, sf_dir, "orders"), _altered_orders(spark, sf_dir), ["o_orderkey"], "orders"
    )


@query(_ALTERED + """
SELECT o_orderkey, o_orderstatus, 1::BIGINT AS missing, 0::BIGINT AS extra
FROM (SELECT o_orderkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM tgt)
UNION ALL
SELECT o_orderkey, o_orderstatus, 0::BIGINT, 1::BIGINT
FROM (SELECT o_orderkey, o_orderstatus FROM tgt EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM orders)
""")
def differing_rows(spark, sf_dir):
    wanted = ["o_orderkey", "o_orderstatus"]
    return row_difference(
        table(spark, sf_dir, "orders").select(*wanted), _altered_orders(spark, sf_dir).select(*wanted)
    )


# --- ordered lists -------------------------------------------------------------------


@query("""
SELECT conv_id, 0::BIGINT AS block, CAST(count(*) AS INTEGER) AS n,
       string_agg(role || ':' || length(text), ',' ORDER BY turn) AS turns
FROM conversations GROUP BY conv_id
""", name="collect_ordered")
def collect_turns(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat("role", F.lit(":"), F.length("text").cast("string")).alias("said")
    )
    lists = collect_ordered(rows, ["conv_id"], "said", "turn", first=0)
    return lists.select("conv_id", "block", "n", F.array_join("values", ",").alias("turns"))


@query("""
SELECT l_orderkey, CAST((l_linenumber - 1) // 3 AS BIGINT) AS block, CAST(count(*) AS INTEGER) AS n,
       string_agg(CAST(part AS VARCHAR), ',' ORDER BY l_linenumber) AS parts
FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part FROM lineitem GROUP BY ALL)
GROUP BY l_orderkey, 2
""")
def collect_line_parts(spark, sf_dir):
    # Line numbers repeat within an order here, so one part per position is chosen first.
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))
    lists = collect_ordered(rows, ["l_orderkey"], "part", "l_linenumber", block=3)
    return lists.select("l_orderkey", "block", "n", F.array_join(F.col("values").cast("array<string>"), ",").alias("parts"))
