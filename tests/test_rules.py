import pytest
from pyspark.sql import types as T

from sparkload.model import CastRule, ColumnSpec
from sparkload.operators.casting import resolve_casts
from sparkload.plans import rules as rl
from sparkload.plans.types import spark_type, target_field

MYSQL = [
    ("tinyint(1)", "", "boolean", True, "tinyint-to-bool"),
    ("tinyint(4)", "", "smallint", True, None),
    ("smallint(6)", "", "smallint", True, None),
    ("mediumint(9)", "", "integer", True, None),
    ("int(11)", "", "integer", True, None),
    ("bigint(20)", "", "bigint", True, None),
    ("tinyint(3) unsigned", "", "smallint", True, None),
    ("smallint(5) unsigned", "", "integer", True, None),
    ("mediumint(8) unsigned", "", "integer", True, None),
    ("int(10) unsigned", "", "bigint", True, None),
    ("bigint(20) unsigned", "", "numeric(20)", True, None),
    ("int(11)", "auto_increment", "serial", True, "int-to-id"),
    ("int(10) unsigned", "auto_increment", "bigserial", True, "int-to-id"),
    ("bigint(20)", "auto_increment", "bigserial", True, "int-to-id"),
    ("mediumint(9)", "auto_increment", "serial", True, None),
    ("smallint(6)", "auto_increment", "serial", True, None),
    ("tinyint(4)", "auto_increment", "serial", True, None),
    ("float", "", "float", False, None),
    ("double", "", "double precision", False, None),
    ("decimal(18,6)", "", "numeric(18,6)", False, None),
    ("numeric(10,2)", "", "numeric(10,2)", False, None),
    ("char(1)", "", "char(1)", False, None),
    ("varchar(255)", "", "varchar(255)", False, None),
    ("longtext", "", "text", True, "remove-null-chars"),
    ("binary(16)", "", "bytea", True, None),
    ("longblob", "", "bytea", True, None),
    ("datetime", "", "timestamptz", True, "zero-dates-to-null"),
    ("timestamp", "on update CURRENT_TIMESTAMP", "timestamptz", True, "zero-dates-to-null"),
    ("date", "", "date", True, "zero-dates-to-null"),
    ("year(4)", "", "smallint", True, None),
    ("enum('a','b')", "", "text", True, None),
    ("set('x','y')", "", "text", True, None),
    ("json", "", "jsonb", True, None),
    ("bit(1)", "", "boolean", True, "bit-to-bool"),
    ("bit(8)", "", "bit varying(8)", False, "bit-to-binstr"),
    ("linestring", "", "path", True, "wkt-to-geometry"),
    ("INT(11)", "", "integer", True, None),
    ("NoSuchType(3)", "", "nosuchtype", False, None),
]
MSSQL = [
    ("nvarchar(255)", "", "text", True, None),
    ("xml", "", "xml", True, None),
    ("int", "auto_increment", "bigserial", True, None),
    ("smallint", "auto_increment", "smallserial", True, None),
    ("tinyint", "auto_increment", "serial", True, None),
    ("tinyint", "", "smallint", True, None),
    ("bit", "", "boolean", True, "sql-server-bit-to-boolean"),
    ("uniqueidentifier", "", "uuid", True, "sql-server-uniqueidentifier-to-uuid"),
    ("geography", "", "bytea", True, "byte-vector-to-bytea"),
    ("float(53)", "", "float", False, "float-to-string"),
    ("decimal(18,6)", "", "numeric", False, "float-to-string"),
    ("money", "", "numeric", True, "float-to-string"),
    ("datetimeoffset", "", "timestamptz", True, None),
    ("date", "", "date", False, None),
]
SQLITE = [
    ("INTEGER", "auto_increment", "bigserial", True, "int-to-id"),
    ("INTEGER", "", "bigint", True, None),
    ("VARCHAR(255)", "", "text", True, None),
    ("NUMERIC", "", "numeric", False, None),
    ("DECIMAL(8,3)", "", "decimal(8,3)", False, None),
    ("BLOB", "", "bytea", True, None),
]
PGSQL = [
    ("money", "", "numeric", True, "money-to-numeric"),
    ("regclass", "", "regclass", True, None),
    ("xid", "", "bigint", True, None),
    ("pg_lsn", "", "text", True, None),
    ("jsonb", "", "jsonb", False, None),
    ("timestamp(3) with time zone", "", "timestamp with time zone", False, None),
]
ALL = [(d, *row) for d, rows in (("mysql", MYSQL), ("mssql", MSSQL), ("sqlite", SQLITE), ("pgsql", PGSQL)) for row in rows]


@pytest.mark.parametrize("dialect,column_type,extra,target,drop,transform", ALL)
def test_resolution(dialect, column_type, extra, target, drop, transform):
    got = rl.resolve(rl.DEFAULT_RULES[dialect], ColumnSpec("c", column_type, extra=extra))
    assert (got.target, got.drop_typemod, got.transform) == (target, drop, transform)


@pytest.mark.parametrize("dialect", list(rl.DEFAULT_RULES))
def test_table_form_agrees_with_the_vectors(spark, dialect):
    rows = [r[1:] for r in ALL if r[0] == dialect]
    df = spark.createDataFrame([(i, r[0], r[1] or None) for i, r in enumerate(rows)], "i int, column_type string, extra string")
    got = resolve_casts(df, rl.DEFAULT_RULES[dialect]).orderBy("i").collect()
    assert [(g.target_type, g.drop_typemod, g.transform) for g in got] == [r[2:] for r in rows]


def test_table_form_uses_no_shuffle_and_no_join(spark):
    df = spark.createDataFrame([("int", "")], "column_type string, extra string")
    plan = resolve_casts(df, rl.MYSQL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_user_rules_come_first_and_shadow_defaults():
    rules = rl.with_user_rules([CastRule("tinyint", "smallint", drop_typemod=True)], "mysql")
    assert rl.resolve(rules, ColumnSpec("c", "tinyint(1)")).target == "smallint"
    wildcard = rl.with_user_rules([CastRule("", "text", on_update=True)], "mysql")
    assert rl.resolve(wildcard, ColumnSpec("c", "datetime", extra="on update CURRENT_TIMESTAMP")).target == "text"
    assert rl.resolve(wildcard, ColumnSpec("c", "datetime")).target == "timestamptz"


@pytest.mark.parametrize(
    "text,mod,base",
    [("varchar(255)", "255", "varchar"), ("decimal(18,6)", "18,6", "decimal"), ("int", "", "int"), ("", "", ""),
     ("tinyint(1)", "1", "tinyint"), ("int(10) unsigned", "10", "int"), ("bigint unsigned", "", "bigint")],
)
def test_typemod_and_base_type(text, mod, base):
    assert rl.parse_typemod(text) == mod
    assert rl.base_type(text) == base


def test_typemod_params():
    assert rl.typemod_params("255") == (255, 0)
    assert rl.typemod_params("18, 6") == (18, 6)
    assert rl.typemod_params("") == (0, 0)


@pytest.mark.parametrize(
    "target,mod,want",
    [("varchar($mod)", "255", "varchar(255)"), ("numeric($mod)", "18,6", "numeric(18,6)"),
     ("integer", "", "integer"), ("bit varying($mod)", "8", "bit varying(8)"), ("numeric($mod)", "", "numeric")],
)
def test_substitute_typemod(target, mod, want):
    assert rl.substitute_typemod(target, mod) == want


@pytest.mark.parametrize(
    "args,want",
    [(("float", 53), "float(53)"), (("float",), "float"), (("decimal", 18, 6), "decimal(18,6)"),
     (("decimal", 18), "decimal(18)"), (("varchar", 0, 0, 255), "varchar(255)"), (("nchar", 0, 0, 10), "nchar(10)"),
     (("varchar", 0, 0, -1), "varchar"), (("datetime", 0, 0, 0, 3), "datetime(3)"), (("int",), "int")],
)
def test_mssql_column_type(args, want):
    assert rl.mssql_column_type(*args) == want


@pytest.mark.parametrize(
    "target,source,want",
    [("numeric(20)", "", T.DecimalType(20, 0)), ("numeric", "decimal(18,6)", T.DecimalType(18, 6)),
     ("numeric", "money", T.DecimalType(19, 4)), ("numeric", "", T.DecimalType(38, 10)),
     ("float", "", T.DoubleType()), ("real", "", T.FloatType()), ("bit varying(8)", "", T.StringType()),
     ("text[]", "", T.ArrayType(T.StringType())), ("smallserial", "", T.ShortType()),
     ("timestamp", "", T.TimestampNTZType()), ("jsonb", "", T.VariantType())],
)
def test_spark_types(target, source, want):
    assert spark_type(target, source) == want


def test_type_errors_are_raised_at_plan_time():
    with pytest.raises(ValueError):
        spark_type("numeric(50,2)")
    with pytest.raises(ValueError):
        spark_type("mood", refuse_unlisted=True)
    assert spark_type("mood", labels=("happy",), refuse_unlisted=True) == T.StringType()


def test_types_without_a_rule_are_text():
    assert spark_type("mood") == spark_type("sql_variant") == spark_type("") == T.StringType()


def test_field_metadata_keeps_serial_and_comment():
    field, _ = target_field(ColumnSpec("id", "int(11)", False, "auto_increment", comment="key"), rl.MYSQL_RULES)
    assert field.metadata["auto_increment"] is True and field.metadata["comment"] == "key"
    assert field.dataType == T.IntegerType() and not field.nullable


def test_postgres_money_holds_every_64_bit_amount():
    field, _ = target_field(ColumnSpec("amount", "money"), rl.PGSQL_RULES)
    assert field.dataType == T.DecimalType(21, 4)
