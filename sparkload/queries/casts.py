"""Queries of rule resolution and table casts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import CastRule, ColumnSpec
from ..operators.casting import ERRORS, cast_table, resolve_casts
from ..operators.rejects import checked_rows, load_with_rejects
from ..plans.rules import MYSQL_RULES
from ..sinks import encode_copy_text
from .registry import query, table

# --- orders as a MySQL dump would hand them over ------------------------------------

ORDERS_COLUMNS = (
    ColumnSpec("o_orderkey", "bigint(20)", nullable=False),
    ColumnSpec("o_custkey", "int(10) unsigned", nullable=False),
    ColumnSpec("o_orderstatus", "enum('F','O','P')", labels=("F", "O", "P")),
    ColumnSpec("o_totalprice", "varchar(20)"),
    ColumnSpec("o_orderdate", "date"),
    ColumnSpec("urgent", "tinyint(1)"),
)
# Money text becomes a number by a user rule that stands before the default one.
ORDERS_RULES = (CastRule("varchar", "numeric(15,2)", type_mod="(20)", drop_typemod=True, transform="money-to-numeric"),)


def raw_orders(spark, sf_dir):
    """Orders as text, with dirty cells at fixed keys: bad numbers, labels, dates, zero dates."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 97 == 3, F.concat(F.lit("x"), key.cast("string"))).otherwise(key.cast("string")).alias("o_orderkey"),
        F.when(key % 89 == 7, None).otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(key % 83 == 5, "Z").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("o_totalprice"),
        F.when(key % 53 == 0, "0000-00-00")
        .when(key % 101 == 9, "1997-02-30")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("o_orderdate"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "1").otherwise("0").alias("urgent"),
    )


_DIRTY_ORDERS = """
WITH dirty AS (
  SELECT *, o_orderkey % 97 = 3 AS bad_key, o_orderkey % 89 = 7 AS bad_cust, o_orderkey % 83 = 5 AS bad_status,
         o_orderkey % 53 = 0 AS zero_date, o_orderkey % 53 <> 0 AND o_orderkey % 101 = 9 AS bad_date
  FROM orders)
"""


@query(_DIRTY_ORDERS + """
SELECT CASE WHEN bad_status THEN 'Z' ELSE o_orderstatus END AS status,
       count(*) FILTER (NOT (bad_key OR bad_cust OR bad_status OR bad_date)) AS good,
       count(*) FILTER (bad_key OR bad_cust OR bad_status OR bad_date) AS rejected,
       count(*) FILTER (NOT (bad_key OR bad_cust OR bad_status OR bad_date) AND zero_date) AS null_dates,
       count(*) FILTER (NOT (bad_key OR bad_cust OR bad_status OR bad_date) AND o_orderpriority = '1-URGENT') AS urgent,
       CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(15,2)))
                FILTER (NOT (bad_key OR bad_cust OR bad_status OR bad_date)), 0) AS DECIMAL(38,2)) AS price
FROM dirty GROUP BY 1
""")
def cast_orders_rejects(spark, sf_dir):
    checked = checked_rows(
        raw_orders(spark, sf_dir), ORDERS_COLUMNS, "mysql", ORDERS_RULES, key_columns=("o_orderstatus",)
    )
    good = F.col(ERRORS).isNull()
    return checked.groupBy(F.col("_key_o_orderstatus").alias("status")).agg(
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("rejected"),
        F.count_if(good & F.col("o_orderdate").isNull()).alias("null_dates"),
        F.count_if(good & F.col("urgent")).alias("urgent"),
        F.coalesce(F.sum(F.when(good, F.col("o_totalprice"))), F.lit(0)).cast("decimal(38,2)").alias("price"),
    )


@query(_DIRTY_ORDERS + """
SELECT 'orders' AS "table", 'o_orderkey' AS "column", 'x' || o_orderkey AS value, 'not a valid bigint' AS reason
FROM dirty WHERE bad_key
UNION ALL SELECT 'orders', 'o_custkey', NULL, 'null value in a not-null column' FROM dirty WHERE bad_cust
UNION ALL SELECT 'orders', 'o_orderstatus', 'Z', 'not a label of the enum' FROM dirty WHERE bad_status
UNION ALL SELECT 'orders', 'o_orderdate', '1997-02-30', 'not a valid date' FROM dirty WHERE bad_date
""")
def reject_rows(spark, sf_dir):
    result = load_with_rejects(
        raw_orders(spark, sf_dir), ORDERS_COLUMNS, "mysql", ORDERS_RULES, table="orders", key_columns=("o_orderkey",)
    )
    return result.rejects.drop("key")


@query(_DIRTY_ORDERS + """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
       CASE WHEN zero_date THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
       o_orderpriority = '1-URGENT' AS urgent
FROM dirty WHERE NOT (bad_key OR bad_cust OR bad_status OR bad_date)
""")
def good_rows(spark, sf_dir):
    return load_with_rejects(raw_orders(spark, sf_dir), ORDERS_COLUMNS, "mysql", ORDERS_RULES).good


# --- whole tables, by dialect --------------------------------------------------------

LINEITEM_COLUMNS = (
    ColumnSpec("l_orderkey", "bigint(20)", nullable=False),
    ColumnSpec("l_partkey", "int(11)"),
    ColumnSpec("l_linenumber", "tinyint(4)"),
    ColumnSpec("l_quantity", "smallint(6)"),
    ColumnSpec("l_extendedprice", "decimal(12,2)"),
    ColumnSpec("l_discount", "double"),
    ColumnSpec("l_returnflag", "char(1)"),
    ColumnSpec("l_shipdate", "datetime"),
)


def raw_lineitem(spark, sf_dir):
    """Line items as text; part key 13 overflows, flag R is too long, line 7 has no date."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.when(F.col("l_partkey") == 13, "99999999999").otherwise(F.col("l_partkey").cast("string")).alias("l_partkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        F.col("l_quantity").cast("int").cast("string").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("l_extendedprice"),
        F.col("l_discount").cast("string").alias("l_discount"),
        F.when(F.col("l_quantity") == 50, F.concat("l_returnflag", F.lit("?"))).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_linenumber") == 7, "0000-00-00 00:00:00")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("l_shipdate"),
    )


@query("""
SELECT l_linenumber,
       count(*) FILTER (l_partkey <> 13 AND l_quantity <> 50) AS good,
       count(*) FILTER (l_partkey = 13 OR l_quantity = 50) AS rejected,
       count(*) FILTER (l_partkey <> 13 AND l_quantity <> 50 AND l_linenumber <> 7) AS dated,
       CAST(sum(CASE WHEN l_partkey <> 13 AND l_quantity <> 50 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END) AS DECIMAL(38,2)) AS price
FROM lineitem GROUP BY l_linenumber
""")
def cast_lineitem(spark, sf_dir):
    checked = cast_table(raw_lineitem(spark, sf_dir).withColumn("n", F.col("l_linenumber").cast("int")), LINEITEM_COLUMNS, "mysql", keep=("n",))
    good = F.col(ERRORS).isNull()
    return checked.groupBy(F.col("n").alias("l_linenumber")).agg(
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("rejected"),
        F.count_if(good & F.col("l_shipdate").isNotNull()).alias("dated"),
        F.sum(F.when(good, F.col("l_extendedprice"))).cast("decimal(38,2)").alias("price"),
    )


@query("""
SELECT c_custkey AS id, lower(c_name) AS name, c_nationkey < 12 AS active, CAST(c_acctbal AS DECIMAL(19,4)) AS balance,
       substr(md5(c_name), 1, 8) || '-' || substr(md5(c_name), 9, 4) || '-' || substr(md5(c_name), 13, 4) || '-' ||
       substr(md5(c_name), 17, 4) || '-' || substr(md5(c_name), 21, 12) AS guid,
       lower(hex(encode(c_mktsegment))) AS tag
FROM customer
""")
def cast_customer_mssql(spark, sf_dir):
    columns = (
        ColumnSpec("id", "bigint", extra="auto_increment", nullable=False),
        ColumnSpec("name", "nvarchar(40)", nullable=False),
        ColumnSpec("active", "bit"),
        ColumnSpec("balance", "money"),
        ColumnSpec("guid", "uniqueidentifier"),
        ColumnSpec("tag", "varbinary(100)"),
    )
    guid = F.regexp_replace(F.upper(F.md5("c_name")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "{$1-$2-$3-$4-$5}")
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.lower("c_name").alias("name"),
        (F.col("c_nationkey") < 12).alias("active"),
        F.col("c_acctbal").cast("decimal(19,4)").alias("balance"),
        guid.alias("guid"),
        F.encode("c_mktsegment", "UTF-8").alias("tag"),
    )
    out = cast_table(raw, columns, "mssql")
    return out.filter(F.col(ERRORS).isNull()).drop(ERRORS).withColumn("tag", F.lower(F.hex("tag")))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, CAST(value AS DECIMAL(21,4)) AS amount,
       '{"k":' || regexp_extract(props, '[0-9]+') || '}' AS props, event_type || ',' || user_id AS tags
FROM events
""")
def cast_events_pgsql(spark, sf_dir):
    columns = (
        ColumnSpec("event_id", "bigint", nullable=False),
        ColumnSpec("at", "timestamp without time zone"),
        ColumnSpec("amount", "money"),
        ColumnSpec("props", "jsonb", nullable=False),
        ColumnSpec("tags", "text[]"),
    )
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"),
        F.concat(F.when(F.col("value") < 0, "-$").otherwise("$"), F.format_number(F.abs("value"), 2)).alias("amount"),
        "props",
        F.concat(F.lit('{"'), "event_type", F.lit('",'), F.col("user_id").cast("string"), F.lit("}")).alias("tags"),
    )
    out = cast_table(raw, columns, "pgsql")
    return out.filter(F.col(ERRORS).isNull()).select(
        "event_id",
        F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"),
        "amount",
        F.to_json("props").alias("props"),
        F.array_join("tags", ",").alias("tags"),
    )


@query("""
SELECT event_type, count(*) FILTER (event_id % 13 <> 0) AS valid, count(*) FILTER (event_id % 13 = 0) AS invalid,
       CAST(sum(CAST(regexp_extract(props, '[0-9]+') AS BIGINT)) FILTER (event_id % 13 <> 0) AS BIGINT) AS k
FROM events GROUP BY event_type
""")
def json_validity(spark, sf_dir):
    broken = F.when(F.col("event_id") % 13 == 0, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    raw = table(spark, sf_dir, "events").select("event_type", broken.alias("props"))
    out = cast_table(raw, (ColumnSpec("event_type", "varchar(20)"), ColumnSpec("props", "json")), "mysql")
    good = F.col(ERRORS).isNull()
    return out.groupBy("event_type").agg(
        F.count_if(good).alias("valid"),
        F.count_if(~good).alias("invalid"),
        F.sum(F.when(good, F.try_variant_get("props", "$.k", "bigint"))).alias("k"),
    )


# --- a catalog of columns ------------------------------------------------------------


@query("""
WITH typed AS (
  SELECT p_partkey,
         CASE p_partkey % 12
           WHEN 0 THEN 'tinyint(' || p_size || ')' WHEN 1 THEN 'int(11)' WHEN 2 THEN 'INT(10) unsigned'
           WHEN 3 THEN 'bigint(20) unsigned' WHEN 4 THEN 'decimal(' || (p_size + 2) || ',2)'
           WHEN 5 THEN 'varchar(' || p_size || ')' WHEN 6 THEN 'bit(' || p_size || ')' WHEN 7 THEN 'datetime'
           WHEN 8 THEN 'longtext' WHEN 9 THEN 'json' WHEN 10 THEN 'bigint(20)' ELSE lower(p_type) END AS column_type,
         CASE WHEN p_size % 2 = 0 THEN 'auto_increment' ELSE '' END AS extra
  FROM part),
rules(no, source, typemod, uns, auto, target, dropped, transform) AS (VALUES
  (1, 'bit', '(1)', NULL, NULL, 'boolean', true, 'bit-to-bool'),
  (2, 'bit', '', NULL, NULL, 'bit varying($mod)', false, 'bit-to-binstr'),
  (3, 'tinyint', '(1)', NULL, NULL, 'boolean', true, 'tinyint-to-bool'),
  (4, 'int', '', true, true, 'bigserial', true, 'int-to-id'),
  (5, 'int', '', NULL, true, 'serial', true, 'int-to-id'),
  (6, 'bigint', '', NULL, true, 'bigserial', true, 'int-to-id'),
  (7, 'tinyint', '', NULL, true, 'serial', true, NULL),
  (8, 'int', '', true, NULL, 'bigint', true, NULL),
  (9, 'bigint', '', true, NULL, 'numeric(20)', true, NULL),
  (10, 'tinyint', '', NULL, NULL, 'smallint', true, NULL),
  (11, 'int', '', NULL, NULL, 'integer', true, NULL),
  (12, 'bigint', '', NULL, NULL, 'bigint', true, NULL),
  (13, 'decimal', '', NULL, NULL, 'numeric($mod)', false, NULL),
  (14, 'varchar', '', NULL, NULL, 'varchar($mod)', false, NULL),
  (15, 'longtext', '', NULL, NULL, 'text', true, 'remove-null-chars'),
  (16, 'datetime', '', NULL, NULL, 'timestamptz', true, 'zero-dates-to-null'),
  (17, 'json', '', NULL, NULL, 'jsonb', true, NULL)),
matched AS (
  SELECT t.*, r.*, row_number() OVER (PARTITION BY p_partkey ORDER BY r.no) AS rn
  FROM typed t LEFT JOIN rules r
    ON lower(regexp_extract(t.column_type, '^[A-Za-z]+')) = r.source AND contains(t.column_type, r.typemod)
   AND (r.uns IS NULL OR r.uns = contains(t.column_type, 'unsigned'))
   AND (r.auto IS NULL OR r.auto = (t.extra = 'auto_increment')))
SELECT p_partkey, column_type, extra,
       coalesce(replace(target, '$mod', regexp_extract(column_type, '\\((.*)\\)', 1)), lower(column_type)) AS target_type,
       coalesce(dropped, false) AS drop_typemod, transform
FROM matched WHERE rn = 1
""", name="resolve_casts")
def resolve_column_casts(spark, sf_dir):
    size = F.col("p_size").cast("string")
    kinds = [
        F.concat(F.lit("tinyint("), size, F.lit(")")),
        F.lit("int(11)"),
        F.lit("INT(10) unsigned"),
        F.lit("bigint(20) unsigned"),
        F.concat(F.lit("decimal("), (F.col("p_size") + 2).cast("string"), F.lit(",2)")),
        F.concat(F.lit("varchar("), size, F.lit(")")),
        F.concat(F.lit("bit("), size, F.lit(")")),
        F.lit("datetime"),
        F.lit("longtext"),
        F.lit("json"),
        F.lit("bigint(20)"),
        F.lower("p_type"),
    ]
    catalog = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.get(F.array(*kinds), (F.col("p_partkey") % len(kinds)).cast("int")).alias("column_type"),
        F.when(F.col("p_size") % 2 == 0, "auto_increment").otherwise("").alias("extra"),
    )
    return resolve_casts(catalog, MYSQL_RULES)


@query("""
SELECT event_id % 7 AS kind, count(*) AS n_rows, count(*) FILTER (event_id % 7 IN (1, 2, 3)) AS rejected
FROM events GROUP BY 1
""")
def cast_dates_with_rest(spark, sf_dir):
    """Dates with a text, a bad time or a digit too many after them are rejects; unlisted types are carried as text."""
    day = F.date_format("ts", "yyyy-MM-dd")
    rest = F.get(F.array(*[F.lit(x) for x in ("", " garbage", " 25:00:00", "1", " 10:20", "T10:20:30.5", " 10:20:30Z")]), F.pmod("event_id", F.lit(7)).cast("int"))
    raw = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), F.concat(day, rest).alias("day"), F.col("event_type").alias("kind"))
    columns = (ColumnSpec("event_id", "bigint"), ColumnSpec("day", "date"), ColumnSpec("kind", "sql_variant"))
    out = cast_table(raw.filter("kind IS NOT NULL"), columns, "mssql")
    return out.groupBy((F.col("event_id") % 7).alias("kind")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(ERRORS).isNotNull()).alias("rejected")
    )


NESTED_RULES = (
    CastRule("grid", "integer[][]"),
    CastRule("place", "composite(key bigint,label text,price numeric(15,2),tags text[],rest integer)"),
)
_NESTED = """
WITH o AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, CAST(o_totalprice AS DECIMAL(15,2)) AS p,
         o_orderkey % 10 = 3 AS ragged, o_orderkey % 7 = 2 AS bad_price FROM orders)
"""


def nested_orders(spark, sf_dir):
    """Orders with a nested array, ragged in one of ten, and a composite, with a bad number in one of seven."""
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    price = F.when(F.col("o_orderkey") % 7 == 2, "12x").otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    ragged = F.concat(F.lit("{{"), key, F.lit(",1},{"), cust, F.lit("}}"))
    grid = F.concat(F.lit("{{"), key, F.lit(",NULL},{"), cust, F.lit(', "7" }}'))
    place = F.concat(F.lit("("), key, F.lit(',"a, (""'), F.col("o_orderstatus"), F.lit('"") \\\\ b",'), price, F.lit(',"{x,""y z""}",)'))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 == 3, ragged).otherwise(grid).alias("grid"), place.alias("place")
    )


@query(_NESTED + """
SELECT ragged, bad_price, count(*) AS n_rows, count(*) FILTER (NOT ragged) AS grids, count(*) FILTER (NOT bad_price) AS places,
       CAST(sum(c) FILTER (NOT ragged) AS BIGINT) AS second_rows, CAST(sum(p) FILTER (NOT bad_price) AS VARCHAR) AS prices
FROM o GROUP BY ALL
""")
def cast_nested_values(spark, sf_dir):
    columns = (ColumnSpec("o_orderkey", "bigint"), ColumnSpec("grid", "grid"), ColumnSpec("place", "place"))
    out = cast_table(nested_orders(spark, sf_dir), columns, "pgsql", NESTED_RULES)
    return out.groupBy((F.col("o_orderkey") % 10 == 3).alias("ragged"), (F.col("o_orderkey") % 7 == 2).alias("bad_price")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("grid").alias("grids"),
        F.count("place").alias("places"),
        F.sum(F.col("grid")[1][0]).alias("second_rows"),
        F.sum("place.price").cast("string").alias("prices"),
    )


@query(_NESTED + """
SELECT k || chr(9) || '{{"' || k || '",NULL},{"' || c || '","7"}}' || chr(9) ||
       '(' || k || ',"a, (""' || s || '"") ' || repeat(chr(92), 4) || ' b",' || p || ',"{""x"",""y z""}",)' AS value
FROM o WHERE NOT ragged AND NOT bad_price
""")
def nested_copy_text(spark, sf_dir):
    """Nested arrays and composites out of the casts, as COPY lines."""
    columns = (ColumnSpec("o_orderkey", "bigint"), ColumnSpec("grid", "grid"), ColumnSpec("place", "place"))
    out = cast_table(nested_orders(spark, sf_dir), columns, "pgsql", NESTED_RULES)
    return encode_copy_text(out.filter(F.col(ERRORS).isNull()).drop(ERRORS))
