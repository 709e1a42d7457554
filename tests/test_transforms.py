import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkload.functions import transforms as tf
from sparkload.functions.text import null_if, trim_space

STRING, BINARY, LONG, DOUBLE, BOOL = (
    T.StringType(), T.BinaryType(), T.LongType(), T.DoubleType(), T.BooleanType(),
)


def run(spark, transform, dtype, values):
    """Apply the transform over a real column, so that nothing is constant folded."""
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("v", dtype)])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    rows = df.select("i", transform(F.col("v"), dtype).alias("out")).orderBy("i").collect()
    return [bytes(r.out) if isinstance(r.out, bytearray) else r.out for r in rows]


CASES = {
    ("tinyint-to-bool", LONG): [(0, False), (1, True), (42, True), (None, None)],
    ("tinyint-to-bool", STRING): [("0", False), ("1", True), ("00", True), (None, None)],
    ("tinyint-to-bool", BINARY): [(b"0", False), (b"1", True), (None, None)],
    ("tinyint-to-bool", DOUBLE): [(0.0, False), (0.5, True)],
    ("zero-dates-to-null", STRING): [
        ("0000-00-00", None), ("0000-00-00 00:00:00", None), ("2024-01-15", "2024-01-15"),
        ("2024-01-15 10:30:00", "2024-01-15 10:30:00"), ("0000-00-00 00:00:01", "0000-00-00 00:00:01"),
        (None, None),
    ],
    ("zero-dates-to-null", BINARY): [(b"0000-00-00", None), (b"2024-01-15", b"2024-01-15"), (None, None)],
    ("remove-null-chars", STRING): [
        ("hello\x00world", "helloworld"), ("normal", "normal"), ("\x00\x00", ""), (None, None),
    ],
    ("remove-null-chars", BINARY): [
        (b"a\x00b", b"ab"), (b"clean", b"clean"), (b"\x10\x00\xff\x00", b"\x10\xff"), (None, None),
    ],
    ("int-to-id", LONG): [(7, 7), (None, None)],
    ("bit-to-bool", BINARY): [(b"\x00", False), (b"\x01", True), (b"\x00\x00", True), (b"", True), (None, None)],
    ("bit-to-bool", STRING): [("\x00", False), ("\x01", True), ("\x00x", False), ("", True), (None, None)],
    ("bit-to-binstr", BINARY): [
        (b"\x00\x01", "0000000000000001"), (b"\xa5", "10100101"), (b"", "0"), (None, None),
        (b"\x00" * 9 + b"\x0f", "0" * 76 + "1111"),
    ],
    ("bit-to-binstr", STRING): [("A", "01000001"), ("", "0"), (None, None)],
    ("wkt-to-geometry", STRING): [
        ("POINT(1 2)", "(1,2)"), ("  POINT( 1.5   -2 ) ", "(1.5,-2)"), ("POINT(1)", "POINT(1)"),
        ("POINT(1 2 3)", "POINT(1 2 3)"), ("LINESTRING(1 2, 3 4)", "((1,2),(3,4))"),
        ("LINESTRING(1 2,3 4 5, 6  7 )", "((1,2),3 4 5,(6,7))"), ("LINESTRING()", "()"),
        ("POLYGON((0 0,1 1))", "POLYGON((0 0,1 1))"), (" x ", " x "), (None, None),
    ],
    ("money-to-numeric", STRING): [
        ("$1,234.56", "1234.56"), ("$1,234,567.89", "1234567.89"), ("EUR 1.234,56", "1234.56"),
        ("1.234,56 €", "1234.56"), ("($1,234.56)", "-1234.56"), ("$0.00", "0.00"), ("$1.99", "1.99"),
        ("$1", "1"), ("", ""), (None, None), ("-$5", "-5"), ("$-5.25", "-5.25"), ("1,234,567", "1234567"),
        ("1.234.567", "1234567"), ("12,5", "12.5"), ("abc", "0"), ("1.234.567,8", "1234567.8"),
        ("-$1,234.50", "-1234.50"), ("$1,234", "1.234"), ("12.", "12."), ("$12,34.5", "1234.5"), (" $7 ", "7"),
    ],
    ("money-to-numeric", BINARY): [(b"$500", "500"), (None, None)],
    ("sql-server-bit-to-boolean", LONG): [(0, False), (1, True), (None, None)],
    ("sql-server-bit-to-boolean", STRING): [
        ("0", False), ("false", False), ("1", True), ("FALSE", True), ("", True), (None, None),
    ],
    ("sql-server-bit-to-boolean", BINARY): [(b"\x00\x01", False), (b"\x01", True), (b"", True), (None, None)],
    ("sql-server-bit-to-boolean", BOOL): [(True, True), (False, False), (None, None)],
    ("sql-server-uniqueidentifier-to-uuid", BINARY): [
        (bytes(range(16)), "03020100-0504-0706-0809-0a0b0c0d0e0f"), (b"{ABC}", "abc"), (None, None),
    ],
    ("sql-server-uniqueidentifier-to-uuid", STRING): [
        (" {6F9619FF-8B86-D011-B42D-00C04FC964FF} ", "6f9619ff-8b86-d011-b42d-00c04fc964ff"),
        ("({A})", "{a}"), ("{(A)}", "a"), ("(A)", "a"), ("A}", "a"), (None, None),
    ],
    ("float-to-string", DOUBLE): [(1.5, "1.5"), (None, None)],
    ("float-to-string", STRING): [("x", "x"), (None, None)],
    ("byte-vector-to-bytea", BINARY): [(b"Hello", "\\x48656c6c6f"), (b"", "\\x"), (None, None)],
    ("byte-vector-to-bytea", STRING): [("Hello", "Hello"), (None, None)],
}


@pytest.mark.parametrize("name,dtype", list(CASES), ids=lambda v: getattr(v, "typeName", lambda: v)())
def test_transform_vectors(spark, name, dtype):
    pairs = CASES[name, dtype]
    got = run(spark, tf.TRANSFORMS[name], dtype, [p[0] for p in pairs])
    assert got == [p[1] for p in pairs]


def test_registry_holds_every_name_of_the_cast_rules():
    from sparkload.plans.rules import DEFAULT_RULES

    used = {r.transform for rules in DEFAULT_RULES.values() for r in rules if r.transform}
    assert used <= set(tf.TRANSFORMS)


def test_unknown_transform_leaves_the_value_alone(spark):
    assert run(spark, lambda c, t: tf.apply_transform("no-such", c, t), STRING, ["a"]) == ["a"]


def test_user_transform_can_be_registered(spark):
    tf.register("shout", lambda c, dt: F.upper(c))
    try:
        assert run(spark, lambda c, t: tf.apply_transform("shout", c, t), STRING, ["a", None]) == ["A", None]
    finally:
        del tf.TRANSFORMS["shout"]


def test_bit_string_of_given_width(spark):
    assert run(spark, lambda c, t: tf.bit_to_binstr(c, t, 4), BINARY, [b"\x05", b"\xff"]) == ["0101", "1111"]


def test_float_text_reads_back_to_the_same_value(spark):
    values = [1e16, 1.25e-11, 0.1, 123456789012345678.0, -2.5e300]
    assert [float(t) for t in run(spark, tf.float_to_string, DOUBLE, values)] == values


def test_invalid_utf8_becomes_the_replacement_character(spark):
    got = run(spark, tf.sanitize_utf8, BINARY, [b"ok", b"a\xffb", "é".encode(), None])
    assert got == ["ok", "a�b", "é", None]


def test_normalize_value(spark):
    as_text = run(spark, lambda c, t: tf.normalize_value(c, t, "sqlite"), BOOL, [True, False, None])
    assert as_text == [1, 0, None]
    stamp = datetime.datetime(2024, 1, 15, 10, 30, 0, 250000)
    assert run(spark, lambda c, t: tf.normalize_value(c, t, "mysql"), T.TimestampType(), [stamp]) == [
        "2024-01-15 10:30:00.250000+00"
    ]
    narrow = run(spark, lambda c, t: tf.normalize_value(c, t, "mysql"), T.ShortType(), [3])
    assert narrow == [3]


def test_trim_is_unicode_aware(spark):
    got = run(spark, lambda c, t: trim_space(c), STRING, ["  a b\t ", "x", "", " \n", None, "a\n\n"])
    assert got == ["a b", "x", "", "", None, "a"]


def test_null_if(spark):
    df = spark.createDataFrame([(" A ", "NULL", "B"), ("NULL", "", "C")], "a string, b string, c string")
    assert [tuple(r) for r in null_if(df, values=["NULL"]).collect()] == [("A", None, "B"), (None, None, "C")]
    kept = null_if(df, values=["NULL"], keep_empty=True).collect()
    assert tuple(kept[1]) == (None, "", "C")
