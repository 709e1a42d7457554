import bisect
import random

import pytest
from pyspark.sql import functions as F

from sparkload.model import CastRule
from sparkload.operators import routing
from sparkload.operators.casting import resolve_casts
from sparkload.operators.rule_table import resolve_casts_table, rules_table
from sparkload.operators.routing import bounds_from_text, default_from_text, route_by_bounds, route_by_values, values_from_text
from sparkload.plans.rules import MSSQL_RULES, MYSQL_RULES

# --- rules as a table ----------------------------------------------------------------

COLUMNS = [
    ("tinyint(1)", ""), ("tinyint(4)", ""), ("int(10) unsigned", "auto_increment"), ("INT(11)", ""), ("bigint(20) unsigned", ""),
    ("decimal(10,2)", ""), ("varchar(40)", None), ("datetime", "on update CURRENT_TIMESTAMP"), ("datetime", ""), ("geometry", ""),
    ("nvarchar(8)", ""), ("money", ""), ("bit", ""), ("bit(3)", ""), ("timestamp(3) with time zone", ""), ("unknown type", ""),
]


def test_each_catalog_has_its_own_rules(spark):
    own = (CastRule("varchar", "citext", type_mod="(40)", drop_typemod=True), CastRule("", "serial", auto_increment=True), *MYSQL_RULES)
    catalogs = {"a": MYSQL_RULES, "b": own, "c": MSSQL_RULES, "d": ()}
    rows = [(name, k, t, e) for name in [*catalogs, "none", None] for k, (t, e) in enumerate(COLUMNS)]
    columns = spark.createDataFrame(rows, "catalog string, k int, column_type string, extra string").repartition(3)
    got = {(r.catalog, r.k): (r.target_type, r.drop_typemod, r.transform) for r in resolve_casts_table(columns, rules_table(spark, catalogs)).collect()}
    assert len(got) == len(rows)
    for name in [*catalogs, "none", None]:
        mine = columns.filter(F.col("catalog").eqNullSafe(F.lit(name)))
        for r in resolve_casts(mine, catalogs.get(name, ())).collect():
            assert got[name, r.k] == (r.target_type, r.drop_typemod, r.transform)
    assert got["b", 6][0] == "citext" and got["b", 2][0] == "serial"


def test_rules_meet_columns_by_equality(spark):
    columns = spark.createDataFrame([("a", "int", "")], "catalog string, column_type string, extra string")
    plan = resolve_casts_table(columns, rules_table(spark, {"a": MYSQL_RULES}))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- bounds as a table ---------------------------------------------------------------

TEXTS = [
    ("p0", "FOR VALUES FROM (MINVALUE, MINVALUE) TO (2019, 'b')"),
    ("p1", "FOR VALUES FROM (2019, 'b') TO (2020, MAXVALUE)"),
    ("p2", "FOR VALUES FROM (2021, 'it''s, (so)') TO (2021, 'z')"),
    ("p3", "FOR VALUES FROM (2021, 'z') TO (2030, MINVALUE)"),
    ("rest", "DEFAULT"),
]


def test_ranges_over_two_columns(spark):
    parts = spark.createDataFrame(TEXTS, "name string, bound string")
    rows = [(2018, "x"), (2019, "a"), (2019, "b"), (2019, "ba"), (2020, "zzz"), (2021, "a"), (2021, "it's, (so)"), (2021, "y"), (2021, "z"), (2029, "é"), (2030, ""), (None, "a"), (2019, None), (-5, "")]
    df = spark.createDataFrame(rows, "year int, segment string")
    got = [r.partition_name for r in route_by_bounds(df, ["year", "segment"], bounds_from_text(parts), default_from_text(parts)).collect()]
    assert got == ["p0", "p0", "p1", "p1", "p1", "rest", "p2", "p2", "p3", "p3", "rest", "rest", "rest", "p0"]
    assert [r.partition_name for r in route_by_bounds(df, ["year", "segment"], bounds_from_text(parts).limit(0)).collect()] == [None] * len(rows)


@pytest.mark.parametrize("constant", [50_000, 0])
def test_many_ranges(spark, monkeypatch, constant):
    monkeypatch.setattr(routing, "CONSTANT_BOUNDS", constant)
    monkeypatch.setattr(routing, "GROUP", 16)
    rng = random.Random(3)
    edges = sorted(rng.sample(range(-40_000, 40_000), 1_201))
    ranges = [(f"r{k}", a, b) for k, (a, b) in enumerate(zip(edges, edges[1:])) if k % 10]
    bounds = spark.createDataFrame([(n, [(0, str(a))], [(0, str(b))]) for n, a, b in ranges], f"name string, low {routing.BOUND}, high {routing.BOUND}")
    keys = [*edges, *(e - 1 for e in edges), *rng.sample(range(-50_000, 50_000), 2_000)]
    lows = [a for _, a, _ in ranges]
    for kind in ("bigint", "decimal(12,2)", "date", "string"):
        if kind == "string":  # texts sort by their bytes
            continue
        cast = (lambda c: F.date_add(F.lit("2000-01-01").cast("date"), c.cast("int"))) if kind == "date" else (lambda c: c.cast(kind))  # noqa: B023
        typed = bounds
        if kind == "date":
            shown = lambda side: F.transform(side, lambda b: F.struct(b["kind"].alias("kind"), F.date_add(F.lit("2000-01-01").cast("date"), b["value"].cast("int")).cast("string").alias("value")))
            typed = bounds.select("name", shown("low").alias("low"), shown("high").alias("high"))
        df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", cast(F.col("k")).alias("key"))
        for r in route_by_bounds(df, ["key"], typed).collect():
            at = bisect.bisect_right(lows, r.k) - 1
            assert r.partition_name == (ranges[at][0] if at >= 0 and r.k < ranges[at][2] else None)


def test_wrong_bounds(spark):
    df = spark.createDataFrame([(1,)], "k int")
    make = lambda *rows: spark.createDataFrame([(n, [(0, a)], [(0, b)]) for n, a, b in rows], f"name string, low {routing.BOUND}, high {routing.BOUND}")
    with pytest.raises(ValueError, match="'a' and 'b' overlap"):
        route_by_bounds(df, ["k"], make(("a", "1", "5"), ("b", "4", "9")))
    with pytest.raises(ValueError, match="empty"):
        route_by_bounds(df, ["k"], make(("a", "5", "5")))
    with pytest.raises(ValueError, match="do not fit"):
        route_by_bounds(df, ["k"], make(("a", "x", "5")))
    with pytest.raises(ValueError, match="no range partitions over double"):
        route_by_bounds(df.select(F.col("k").cast("double").alias("k")), ["k"], make(("a", "1", "5")))


def test_a_range_search_moves_no_rows(spark):
    bounds = bounds_from_text(spark.createDataFrame(TEXTS, "name string, bound string"))
    df = spark.range(10).select(F.col("id").cast("int").alias("year"), F.lit("a").alias("segment"))
    plan = route_by_bounds(df, ["year", "segment"], bounds)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan and "split(" not in plan


def test_lists_of_values(spark):
    parts = spark.createDataFrame([("p1", "FOR VALUES IN ('a', 'b, c')"), ("p2", "FOR VALUES IN ('it''s', NULL, 'NULL')"), ("p3", "DEFAULT")], "name string, bound string")
    df = spark.createDataFrame([("a",), ("b, c",), ("it's",), (None,), ("NULL",), ("other",)], "k string")
    got = {r.k: r.partition_name for r in route_by_values(df, "k", values_from_text(parts), default_from_text(parts)).collect()}
    assert got == {"a": "p1", "b, c": "p1", "it's": "p2", None: "p2", "NULL": "p2", "other": "p3"}
    with pytest.raises(ValueError, match="twice"):
        route_by_values(df, "k", values_from_text(parts).union(values_from_text(parts)))
    with pytest.raises(ValueError, match="does not fit"):
        route_by_values(spark.range(3), "id", values_from_text(parts))
    plan = route_by_values(df, "k", values_from_text(parts))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
