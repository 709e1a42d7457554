import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkload.model import CastRule, ColumnSpec
from sparkload.operators.casting import cast_table, target_schema
from sparkload.operators.rejects import checked_rows, load_with_rejects, write_checked


def cast_values(spark, source_type, values, dtype=T.StringType(), dialect="mysql", **column):
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("v", dtype)])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    out = cast_table(df, [ColumnSpec("v", source_type, **column)], dialect, keep=("i",))
    rows = out.withColumn("reason", F.col("_errors")[0]["reason"]).orderBy("i")
    if isinstance(out.schema["v"].dataType, T.VariantType):
        rows = rows.withColumn("v", F.to_json("v"))
    return [(bytes(r.v) if isinstance(r.v, bytearray) else r.v, r.reason) for r in rows.collect()]


def values_and_flags(result):
    return [(v, r is not None) for v, r in result]


def test_integers(spark):
    got = values_and_flags(cast_values(spark, "smallint(6)", ["1", "-5", "70000", "x", "1.5", "", None]))
    assert got == [(1, False), (-5, False), (None, True), (None, True), (None, True), (None, True), (None, False)]


def test_fractional_number_is_not_an_integer(spark):
    got = values_and_flags(cast_values(spark, "int(11)", [3.0, 2.5, 1e12, float("nan"), None], T.DoubleType()))
    assert got == [(3, False), (None, True), (None, True), (None, True), (None, False)]


def test_unsigned_64_bit_value_survives(spark):
    got = cast_values(spark, "bigint(20) unsigned", ["18446744073709551615", "4294967295"])
    assert got == [(Decimal("18446744073709551615"), None), (Decimal("4294967295"), None)]


def test_floats_reject_overflow_and_java_suffixes(spark):
    got = values_and_flags(cast_values(spark, "double", ["1e400", "1.5d", "1.5", "-Infinity", "nan ", ".5", "5.", " 1e300 ", "0x1p3", "9" * 400, "1e-400"]))
    assert [f for _, f in got] == [True, True, False, False, False, False, False, False, True, True, False]
    assert got[2][0] == 1.5 and got[3][0] == float("-inf")


def test_real_overflow_from_double(spark):
    got = values_and_flags(cast_values(spark, "real", [1e300, 1.5, float("inf")], T.DoubleType(), "sqlite"))
    assert got == [(None, True), (1.5, False), (float("inf"), False)]


def test_real_overflow_from_text(spark):
    got = values_and_flags(cast_values(spark, "real", ["1e39", "9" * 28 + "e9", "3.4e38", "1.5e3"], dialect="sqlite"))
    assert [f for _, f in got] == [True, False, False, False] and got[3][0] == 1500.0


def test_decimals(spark):
    got = values_and_flags(cast_values(spark, "decimal(6,2)", ["1234.565", "12345.0", "1e2", "abc"]))
    assert got == [(Decimal("1234.57"), False), (None, True), (Decimal("100.00"), False), (None, True)]


def test_booleans(spark):
    assert values_and_flags(cast_values(spark, "tinyint(1)", ["0", "1", "7", None])) == [
        (False, False), (True, False), (True, False), (None, False)
    ]
    got = values_and_flags(cast_values(spark, "boolean", ["yes", "OFF", "t", "2"], dialect="pgsql"))
    assert got == [(True, False), (False, False), (True, False), (None, True)]
    got = values_and_flags(cast_values(spark, "bool", [1, 0, 2], T.LongType(), "sqlite"))
    assert got == [(True, False), (False, False), (None, True)]
    assert cast_values(spark, "bit", [True, False], T.BooleanType(), "mssql") == [(True, None), (False, None)]
    assert cast_values(spark, "bit(1)", [b"\x00", b"\x01"], T.BinaryType()) == [(False, None), (True, None)]


def test_dates_and_zero_dates(spark):
    got = values_and_flags(cast_values(spark, "date", ["2024-01-15", "0000-00-00", "2024-02-30", "2024", "10:30:00"]))
    assert got == [(datetime.date(2024, 1, 15), False), (None, False), (None, True), (None, True), (None, True)]
    got = values_and_flags(
        cast_values(spark, "date", ["2024-1-5", "2024-01-15x", "2024-01", "2024-01-15 10:30:00", "12345-01", "2024-01-15 x"])
    )
    day = datetime.date(2024, 1, 15)
    assert got[:4] == [(datetime.date(2024, 1, 5), False), (None, True), (None, True), (day, False)] and got[4][1]


def test_timestamps_keep_microseconds(spark):
    got = cast_values(spark, "datetime", ["2024-01-15 10:30:00.123456", "0000-00-00 00:00:00", "10:30:00"])
    assert got[0] == (datetime.datetime(2024, 1, 15, 10, 30, 0, 123456), None)
    assert got[1] == (None, None) and got[2][1] is not None
    offset = cast_values(spark, "datetimeoffset", ["2024-01-15 10:30:00+02"], dialect="mssql")
    assert offset[0][0] == datetime.datetime(2024, 1, 15, 8, 30)


def test_times(spark):
    got = values_and_flags(cast_values(spark, "time", ["10:30:00", "9:05", "23:59:59.5", "25:00:00", "838:59:59"]))
    assert got == [("10:30:00", False), ("09:05:00", False), ("23:59:59.5", False), (None, True), (None, True)]


def test_length_limit_counts_characters_and_ignores_trailing_blanks(spark):
    got = values_and_flags(cast_values(spark, "varchar(3)", ["abc", "äöü", "ab  ", "abcd", None]))
    assert got == [("abc", False), ("äöü", False), ("ab ", False), (None, True), (None, False)]
    assert values_and_flags(cast_values(spark, "varchar(3)", ["abcd"], dialect="pgsql")) == [(None, True)]


def test_enum_and_not_null(spark):
    labels = ("happy", "sad")
    got = cast_values(spark, "enum('happy','sad')", ["happy", "angry", None], labels=labels)
    assert [r for _, r in got] == [None, "not a label of the enum", None]
    got = cast_values(spark, "varchar(9)", ["x", None], nullable=False)
    assert [r for _, r in got] == [None, "null value in a not-null column"]
    mood = cast_values(spark, "mood", ["sad", "zzz"], dialect="pgsql", labels=labels)
    assert [r for _, r in mood] == [None, "not a label of the enum"]


def test_json(spark):
    got = cast_values(spark, "json", ['{"k": 1}', "{bad", None, " [1, 2] ", "null", '"x"'])
    assert got == [
        ('{"k":1}', None), (None, "invalid JSON"), (None, None), ("[1,2]", None), ("null", None), ('"x"', None)
    ]


@pytest.mark.parametrize("text", ["{}}", "1 2", "1,2", "1],[2", '1},{"a":1', "", "{} x", '1,"b":2', "]", "//"])
def test_text_after_the_json_value_is_invalid(spark, text):
    assert cast_values(spark, "json", [text]) == [(None, "invalid JSON")]


def test_binary_stays_binary(spark):
    assert cast_values(spark, "varbinary(100)", [b"\xff\x00", None], T.BinaryType(), "mssql") == [
        (b"\xff\x00", None), (None, None)
    ]
    got = values_and_flags(cast_values(spark, "bytea", ["\\x68ff", "\\xzz", "\\x123", "plain"], dialect="pgsql"))
    assert got == [(b"h\xff", False), (None, True), (None, True), (b"plain", False)]


def test_bit_strings(spark):
    assert cast_values(spark, "bit(4)", [b"\x05"], T.BinaryType()) == [("0101", None)]
    assert cast_values(spark, "bit(8)", [b"\xa5"], T.BinaryType()) == [("10100101", None)]


def test_uuid(spark):
    good = "6F9619FF-8B86-D011-B42D-00C04FC964FF"
    got = values_and_flags(cast_values(spark, "uniqueidentifier", ["{" + good + "}", "nope"], dialect="mssql"))
    assert got == [(good.lower(), False), (None, True)]


def test_money(spark):
    got = cast_values(spark, "money", ["$1,234.56", "($5.00)"], dialect="pgsql")
    assert [v for v, _ in got] == [Decimal("1234.5600"), Decimal("-5.0000")]
    assert cast_values(spark, "money", [Decimal("922337203685477.5807")], T.DecimalType(19, 4), "mssql") == [
        (Decimal("922337203685477.5807"), None)
    ]


def test_arrays(spark):
    got = values_and_flags(
        cast_values(spark, "text[]", ['{a,"b, \\"c",NULL}', "{}", "{ x , y }", "{{a},{b}}", "a,b"], dialect="pgsql")
    )
    assert got[0] == (["a", 'b, "c', None], False)
    assert got[1] == ([], False) and got[2] == (["x", "y"], False)
    assert got[3] == (None, True) and got[4] == (None, True)
    got = values_and_flags(cast_values(spark, "integer[]", ["{1,2}", "{1,x}"], dialect="pgsql"))
    assert got == [([1, 2], False), (None, True)]


def test_user_rule_beats_default(spark):
    df = spark.createDataFrame([("1",)], "v string")
    rules = [CastRule("tinyint", "smallint", drop_typemod=True)]
    assert cast_table(df, [ColumnSpec("v", "tinyint(1)")], "mysql", rules).schema["v"].dataType == T.ShortType()


def test_registered_transform_may_change_the_type(spark):
    from sparkload.functions import transforms as tf

    tf.register("cents", lambda c, dt: c.cast("decimal(18,0)") / 100)
    try:
        rules = [CastRule("bigint", "numeric(12,2)", drop_typemod=True, transform="cents")]
        df = spark.createDataFrame([(1250,), (None,)], "v bigint")
        out = cast_table(df, [ColumnSpec("v", "bigint(20)")], "mysql", rules, on_error="fail")
        assert [r.v for r in out.collect()] == [Decimal("12.50"), None]
    finally:
        del tf.TRANSFORMS["cents"]


def test_on_error_modes(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    columns = [ColumnSpec("v", "int(11)")]
    assert [r.v for r in cast_table(df, columns, "mysql", on_error="null").collect()] == [1, None]
    with pytest.raises(Exception, match="bad row"):
        cast_table(df, columns, "mysql", on_error="fail").collect()
    with pytest.raises(ValueError):
        cast_table(df, columns, "mysql", on_error="ignore")
    with pytest.raises(ValueError):
        cast_table(df, [ColumnSpec("w", "int(11)")], "mysql")


def test_names_with_spaces_and_quotes(spark):
    df = spark.createDataFrame([("1", "2")], 'id string, `Test"Tbl .x` string')
    out = cast_table(df, [ColumnSpec('Test"Tbl .x', "int(11)"), ColumnSpec("id", "int(11)")], "mysql")
    assert out.columns == ['Test"Tbl .x', "id", "_errors"] and tuple(out.collect()[0]) == (2, 1, None)


COLUMNS = [
    ColumnSpec("id", "int(11)", False, "auto_increment"),
    ColumnSpec("name", "varchar(5)", False),
    ColumnSpec("price", "decimal(10,2)"),
]
RAW = [("1", "ann", "1.5"), ("2", "toolong", "x"), ("3", None, "2"), ("y", "bob", "3"), ("5", "eve", None)]


def test_good_rows_load_once_and_rejects_carry_reasons(spark):
    df = spark.createDataFrame(RAW, "id string, name string, price string")
    result = load_with_rejects(df, COLUMNS, "mysql", table="t", key_columns=("id",))
    assert sorted(r.id for r in result.good.collect()) == [1, 5]
    rejects = sorted(tuple(r) for r in result.rejects.collect())
    assert rejects == [
        ("t", '{"id":"2"}', "name", "toolong", "value longer than 5 characters"),
        ("t", '{"id":"2"}', "price", "x", "not a valid numeric(10,2)"),
        ("t", '{"id":"3"}', "name", None, "null value in a not-null column"),
        ("t", '{"id":"y"}', "id", "y", "not a valid serial"),
    ]
    assert result.good.schema["id"].metadata["auto_increment"] is True


def test_one_write_stores_good_and_rejected_rows(spark, tmp_path):
    df = spark.createDataFrame(RAW, "id string, name string, price string")
    checked = checked_rows(df, COLUMNS, "mysql", key_columns=("id",))
    result = write_checked(checked, str(tmp_path / "t"), COLUMNS, "t", ("id",))
    assert sorted(r.id for r in result.good.collect()) == [1, 5]
    assert result.rejects.count() == 4
    assert [f.dataType for f in result.good.schema] == [f.dataType for f in target_schema(COLUMNS, "mysql")]


def test_result_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(RAW * 50, "id string, name string, price string")
    counts = set()
    for n in (1, 8):
        result = load_with_rejects(df.repartition(n), COLUMNS, "mysql")
        counts.add((result.good.count(), result.rejects.count()))
    assert counts == {(100, 200)}


def test_cast_plan_stays_on_the_jvm_without_shuffle(spark):
    df = spark.createDataFrame(RAW, "id string, name string, price string")
    plan = cast_table(df, COLUMNS, "mysql")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan
