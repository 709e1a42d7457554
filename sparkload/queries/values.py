"""Queries of the value transforms."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import transforms as tf
from ..functions.text import null_if
from .registry import query, table

STRING, BINARY, DOUBLE = T.StringType(), T.BinaryType(), T.DoubleType()


@query("""
SELECT l_returnflag, l_linenumber <> 1 AS flag, count(*) AS n
FROM lineitem GROUP BY ALL
""")
def tinyint_to_bool(spark, sf_dir):
    raw = (F.col("l_linenumber") - 1).cast("string")
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", raw.alias("raw"))
    return rows.groupBy("l_returnflag", tf.tinyint_to_bool(F.col("raw")).alias("flag")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
SELECT l_linestatus, l_discount > 0.02 AS flag, count(*) AS n
FROM lineitem GROUP BY ALL
""")
def mssql_bit_to_boolean(spark, sf_dir):
    raw = (
        F.when(F.col("l_discount") <= 0.01, "0")
        .when(F.col("l_discount") <= 0.02, "false")
        .when(F.col("l_discount") <= 0.05, "1")
        .otherwise("true")
    )
    rows = table(spark, sf_dir, "lineitem").select("l_linestatus", raw.alias("raw"))
    return rows.groupBy("l_linestatus", tf.mssql_bit_to_boolean(F.col("raw")).alias("flag")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d
FROM orders
""")
def zero_dates_to_null(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "0000-00-00")
        .when(F.col("o_orderpriority") == "5-LOW", "0000-00-00 00:00:00")
        .otherwise(day)
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return rows.select("o_orderkey", tf.zero_dates_to_null(F.col("raw")).alias("d"))


@query("""
SELECT doc_id, length(replace(text, ' ', '')) AS n, md5(replace(text, ' ', '')) AS digest FROM documents
""")
def remove_null_chars(spark, sf_dir):
    raw = F.translate("text", " ", "\u0000")
    rows = table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"))
    clean = rows.select("doc_id", tf.remove_null_chars(F.col("raw")).alias("clean"))
    return clean.select("doc_id", F.length("clean").cast("bigint").alias("n"), F.md5("clean").alias("digest"))


@query("""
SELECT doc_id, md5('\\x' || lower(hex(encode(text)))) AS digest FROM documents
""")
def bytes_to_hex(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    return rows.select("doc_id", F.md5(tf.byte_vector_to_bytea(F.col("raw"), BINARY)).alias("digest"))


@query("""
SELECT doc_id, length(text) + 1 AS n, md5(text || chr(65533)) AS digest FROM documents
""")
def utf8_sanitize(spark, sf_dir):
    # A lone FF byte is never valid UTF-8.
    raw = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))
    rows = table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"))
    clean = rows.select("doc_id", tf.sanitize_utf8(F.col("raw"), BINARY).alias("clean"))
    return clean.select("doc_id", F.length("clean").cast("bigint").alias("n"), F.md5("clean").alias("digest"))


@query("""
SELECT p_partkey, p_size > 1 AS flag FROM part
""")
def bit_to_bool(spark, sf_dir):
    raw = F.unhex(F.lpad(F.hex(F.col("p_size") - 1), 2, "0"))
    rows = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    return rows.select("p_partkey", tf.bit_to_bool(F.col("raw"), BINARY).alias("flag"))


@query("""
SELECT p_partkey, (unhex(md5(p_name || CAST(p_partkey AS VARCHAR)))::BIT)::VARCHAR AS bits,
       right((unhex(md5(p_name || CAST(p_partkey AS VARCHAR)))::BIT)::VARCHAR, 12) AS bit12
FROM part
""")
def bit_to_binstr(spark, sf_dir):
    raw = F.unhex(F.md5(F.concat("p_name", F.col("p_partkey").cast("string"))))
    rows = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    return rows.select(
        "p_partkey",
        tf.bit_to_binstr(F.col("raw"), BINARY).alias("bits"),
        tf.bit_to_binstr(F.col("raw"), BINARY, 12).alias("bit12"),
    )


@query("""
WITH h AS (SELECT c_custkey, md5(c_name) AS m FROM customer)
SELECT c_custkey,
       substr(m, 7, 2) || substr(m, 5, 2) || substr(m, 3, 2) || substr(m, 1, 2) || '-' ||
       substr(m, 11, 2) || substr(m, 9, 2) || '-' || substr(m, 15, 2) || substr(m, 13, 2) || '-' ||
       substr(m, 17, 4) || '-' || substr(m, 21, 12) AS from_bytes,
       substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' ||
       substr(m, 21, 12) AS from_text
FROM h
""")
def guid_to_uuid(spark, sf_dir):
    digest = F.upper(F.md5("c_name"))
    grouped = F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", " {$1-$2-$3-$4-$5} ")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.unhex(digest).alias("b"), grouped.alias("t"))
    return rows.select(
        "c_custkey",
        tf.uniqueidentifier_to_uuid(F.col("b"), BINARY).alias("from_bytes"),
        tf.uniqueidentifier_to_uuid(F.col("t"), STRING).alias("from_text"),
    )


@query("""
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag
         WHEN 'A' THEN '(' || l_partkey || ',' || l_suppkey || ')'
         WHEN 'N' THEN '((' || l_partkey || ',' || l_suppkey || '),(' || l_orderkey || ',' || l_linenumber || '))'
         ELSE 'POLYGON((' || l_partkey || ' ' || l_suppkey || '))' END AS geometry
FROM lineitem
""")
def wkt_to_geometry(spark, sf_dir):
    def text(name):
        return F.col(name).cast("string")

    raw = (
        F.when(
            F.col("l_returnflag") == "A",
            F.concat(F.lit(" POINT( "), text("l_partkey"), F.lit("  "), text("l_suppkey"), F.lit(") ")),
        )
        .when(
            F.col("l_returnflag") == "N",
            F.concat(
                F.lit("LINESTRING("), text("l_partkey"), F.lit(" "), text("l_suppkey"), F.lit(" , "),
                text("l_orderkey"), F.lit(" "), text("l_linenumber"), F.lit(")"),
            ),
        )
        .otherwise(F.concat(F.lit("POLYGON(("), text("l_partkey"), F.lit(" "), text("l_suppkey"), F.lit("))")))
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return rows.select("l_orderkey", "l_linenumber", tf.wkt_to_geometry(F.col("raw")).alias("geometry"))


@query("""
SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN -c_acctbal ELSE c_acctbal END AS DECIMAL(15,2)) AS amount
FROM customer
""")
def money_to_numeric(spark, sf_dir):
    balance = F.col("c_acctbal")
    american = F.format_number(balance, 2)
    european = F.translate(american, ",.", ".,")
    segment = F.col("c_mktsegment")
    # Parentheses stand for the sign: a debit of a balance above zero.
    raw = (
        F.when((segment == "AUTOMOBILE") & (balance >= 0), F.concat(F.lit("($"), american, F.lit(")")))
        .when(segment == "AUTOMOBILE", F.format_number(-balance, 2))
        .when(segment == "BUILDING", F.concat(F.lit("EUR "), european))
        .when(segment == "MACHINERY", F.concat(european, F.lit(" €")))
        .otherwise(F.concat(F.lit("$"), american))
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))
    return rows.select("c_custkey", tf.money_to_numeric(F.col("raw")).try_cast("decimal(15,2)").alias("amount"))


@query("""
SELECT l_returnflag, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price, sum(CAST(l_tax AS DECIMAL(18,2))) AS tax
FROM lineitem GROUP BY l_returnflag
""")
def float_to_string(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        tf.float_to_string(F.col("l_extendedprice"), DOUBLE).alias("price"),
        tf.float_to_string(F.col("l_tax"), DOUBLE).alias("tax"),
    )
    return rows.groupBy("l_returnflag").agg(
        F.sum(F.col("price").cast("decimal(18,2)")).cast("decimal(38,2)").alias("price"),
        F.sum(F.col("tax").cast("decimal(18,2)")).cast("decimal(38,2)").alias("tax"),
    )


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CAST(event_type = 'click' AS BIGINT) AS is_click FROM events
""")
def normalize_values(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("event_type") == "click").alias("is_click"))
    return rows.select(
        "event_id",
        *[
            tf.normalize_value(F.col(f.name), f.dataType, "sqlite").alias(f.name)
            for f in rows.schema.fields
            if f.name != "event_id"
        ],
    )


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL ELSE c_mktsegment END AS segment,
       trim(c_name) AS name
FROM customer
""")
def nullif_trim(spark, sf_dir):
    segment = F.when(F.col("c_mktsegment") == "FURNITURE", " \t ").otherwise(
        F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("\n"))
    )
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", segment.alias("segment"), F.concat(F.lit("　"), "c_name", F.lit("\t")).alias("name")
    )
    return null_if(rows, ["segment", "name"], values=["BUILDING"])
