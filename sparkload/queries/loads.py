"""Queries of whole loads: several tables with casts, rejects, checks and a report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..load import LoadOptions, load_database, load_report, load_table, table_path
from ..model import ColumnSpec, ForeignKeySpec, KeySpec, PartitionSpec, TableSpec
from ..session import scratch_dir
from .registry import query, table


def _spec(name, columns, key, fks=()):
    return TableSpec(
        name,
        tuple(ColumnSpec(c, t, nullable=c != key, extra="auto_increment" if c == key else "") for c, t in columns),
        keys=(KeySpec((key,), primary=True),),
        foreign_keys=fks,
    )


SPECS = (
    _spec("region", (("r_regionkey", "int(11)"), ("r_name", "varchar(25)")), "r_regionkey"),
    _spec(
        "nation",
        (("n_nationkey", "int(11)"), ("n_name", "varchar(25)"), ("n_regionkey", "int(11)")),
        "n_nationkey",
        (ForeignKeySpec(("n_regionkey",), "region", ("r_regionkey",)),),
    ),
    _spec(
        "supplier",
        (("s_suppkey", "bigint(20)"), ("s_name", "varchar(25)"), ("s_nationkey", "int(11)"), ("s_acctbal", "decimal(15,2)")),
        "s_suppkey",
        (ForeignKeySpec(("s_nationkey",), "nation", ("n_nationkey",)),),
    ),
    # Customer names have 18 characters, and one more where the source below adds it.
    _spec(
        "customer",
        (("c_custkey", "bigint(20)"), ("c_name", "varchar(18)"), ("c_nationkey", "int(11)"), ("c_acctbal", "decimal(15,2)")),
        "c_custkey",
        (ForeignKeySpec(("c_nationkey",), "nation", ("n_nationkey",)),),
    ),
    _spec(
        "orders",
        (("o_orderkey", "bigint(20)"), ("o_custkey", "bigint(20)"), ("o_totalprice", "decimal(15,2)"), ("o_orderdate", "date")),
        "o_orderkey",
        (ForeignKeySpec(("o_custkey",), "customer", ("c_custkey",)),),
    ),
)


def _raw(spark, sf_dir):
    """Source frames by table: customers of nation 7 have too long a name, and so are rejected."""

    def source(spec: TableSpec) -> DataFrame:
        rows = table(spark, sf_dir, spec.name)
        if spec.name == "customer":
            rows = rows.withColumn(
                "c_name", F.when(F.col("c_nationkey") == 7, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))
            )
        return rows

    return source


def _run(spark, sf_dir, **options):
    return load_database(
        spark, SPECS, _raw(spark, sf_dir), "mysql", scratch_dir(spark, "load"), LoadOptions(**options)
    )


@query("""
SELECT 'region' AS "table", 0 AS errors, count(*) AS rows,
       CAST(sum(strlen(r_regionkey || chr(9) || r_name) + 1) AS BIGINT) AS bytes FROM region
UNION ALL SELECT 'nation', 0, count(*), CAST(sum(strlen(n_nationkey || chr(9) || n_name || chr(9) || n_regionkey) + 1) AS BIGINT) FROM nation
UNION ALL SELECT 'supplier', 0, count(*),
       CAST(sum(strlen(s_suppkey || chr(9) || s_name || chr(9) || s_nationkey || chr(9) || CAST(s_acctbal AS DECIMAL(15,2))) + 1) AS BIGINT)
FROM supplier
UNION ALL SELECT 'customer', count(*) FILTER (c_nationkey = 7), count(*) FILTER (c_nationkey <> 7),
       CAST(sum(strlen(c_custkey || chr(9) || c_name || chr(9) || c_nationkey || chr(9) || CAST(c_acctbal AS DECIMAL(15,2))) + 1)
            FILTER (c_nationkey <> 7) AS BIGINT)
FROM customer
UNION ALL SELECT 'orders', 0, count(*),
       CAST(sum(strlen(o_orderkey || chr(9) || o_custkey || chr(9) || CAST(o_totalprice AS DECIMAL(15,2)) || chr(9) ||
                       strftime(o_orderdate, '%Y-%m-%d')) + 1) AS BIGINT)
FROM orders
""", name="load_report")
def load_report_tables(spark, sf_dir):
    return load_report(spark, _run(spark, sf_dir, data_only=True)).drop("seconds")


@query("""
SELECT 'orders' AS "table", 'foreign key' AS "check", 'o_custkey' AS columns, count(DISTINCT o_custkey) AS n_keys, count(*) AS n_rows
FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_nationkey <> 7)
UNION ALL SELECT 'customer', 'foreign key', 'c_nationkey', 0, 0
UNION ALL SELECT 'supplier', 'foreign key', 's_nationkey', 0, 0
UNION ALL SELECT 'nation', 'foreign key', 'n_regionkey', 0, 0
UNION ALL SELECT t, 'primary key', k, 0, 0 FROM (VALUES ('region', 'r_regionkey'), ('nation', 'n_nationkey'),
  ('supplier', 's_suppkey'), ('customer', 'c_custkey'), ('orders', 'o_orderkey')) v(t, k)
UNION ALL SELECT t, 'not null', k, 0, 0 FROM (VALUES ('region', 'r_regionkey'), ('nation', 'n_nationkey'),
  ('supplier', 's_suppkey'), ('customer', 'c_custkey'), ('orders', 'o_orderkey')) v(t, k)
""")
def load_checks(spark, sf_dir):
    report = _run(spark, sf_dir)
    parts = [t.checks.select(F.lit(name).alias("table"), "*") for name, t in report.tables.items()]
    return reduce(DataFrame.unionByName, parts)


ORDERS_BY_YEAR = TableSpec(
    "orders_by_year",
    SPECS[-1].columns,
    keys=SPECS[-1].keys,
    partitioning=PartitionSpec(
        "range",
        "year(o_orderdate)",
        tuple((f"y{year}", year, year + 1) for year in range(1993, 1999)) + (("later", 1999, None),),
    ),
)


@query("""
SELECT CASE WHEN year(o_orderdate) < 1993 THEN NULL WHEN year(o_orderdate) >= 1999 THEN 'later'
       ELSE 'y' || year(o_orderdate) END AS partition_name,
       CASE WHEN year(o_orderdate) < 1993 THEN 'rejected' ELSE 'good' END AS load_outcome,
       count(*) AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS price
FROM orders GROUP BY ALL
""")
def load_partitioned(spark, sf_dir):
    target = scratch_dir(spark, "load")
    load_table(table(spark, sf_dir, "orders"), ORDERS_BY_YEAR, "mysql", target)
    stored = spark.read.parquet(table_path(target, ORDERS_BY_YEAR))
    return stored.groupBy("partition_name", "load_outcome").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").cast("decimal(38,2)").alias("price")
    )


@query("""
SELECT step, rows, errors, good, rejects FROM (
  SELECT 'schema' AS step, 0 AS rows, 0 AS errors, 0 AS good, 0 AS rejects
  UNION ALL SELECT 'truncate', n, e, n, e FROM (SELECT count(*) FILTER (c_nationkey <> 7) AS n, count(*) FILTER (c_nationkey = 7) AS e FROM customer)
  UNION ALL SELECT 'append', n, e, 2 * n, e FROM (SELECT count(*) FILTER (c_nationkey <> 7) AS n, count(*) FILTER (c_nationkey = 7) AS e FROM customer))
""")
def load_phases(spark, sf_dir):
    """The schema first, then the rows, then the same rows once more: counts and rejects are each step's own."""
    target = scratch_dir(spark, "load")
    spec = next(s for s in SPECS if s.name == "customer")
    rows = _raw(spark, sf_dir)(spec)
    out = []
    for step, options in (("schema", {"schema_only": True}), ("truncate", {"mode": "truncate"}), ("append", {"mode": "append"})):
        loaded = load_table(rows, spec, "mysql", target, LoadOptions(**options))
        out.append((step, loaded.rows, loaded.errors, loaded.good.count(), loaded.rejects.select("key").distinct().count()))
    return spark.createDataFrame(out, "step string, rows bigint, errors bigint, good bigint, rejects bigint")


@query("""
SELECT 'orders' AS "table", 'foreign key, customer not loaded' AS "check", CAST(NULL AS BIGINT) AS n_rows
UNION ALL SELECT 'orders', 'primary key', 0 UNION ALL SELECT 'orders', 'not null', 0
""")
def load_without_parent(spark, sf_dir):
    spec = SPECS[-1]
    report = load_database(spark, [spec], _raw(spark, sf_dir), "mysql", scratch_dir(spark, "load"), LoadOptions())
    return report.tables[spec.qualified_name].checks.select(F.lit("orders").alias("table"), "check", "n_rows")
