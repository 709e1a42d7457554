import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkload.functions.literals import array_literal, composite_literal
from sparkload.model import CastRule, ColumnSpec
from sparkload.operators.casting import ERRORS, cast_table
from sparkload.plans.types import composite_fields, spark_type
from sparkload.sinks import encode_copy_text


def parsed(spark, texts, target):
    parse = composite_literal if isinstance(target, T.StructType) else array_literal
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(2)
    return [r.v for r in df.select("i", parse(F.col("t"), target).alias("v")).orderBy("i").collect()]


def test_nested_arrays(spark):
    two, three = spark_type("integer[][]"), spark_type("text[][][]")
    assert two == T.ArrayType(T.ArrayType(T.IntegerType()))
    cases = [
        ("{{1,2},{3,NULL}}", [[1, 2], [3, None]]), (" { { 1 , 2 } , {3,4} } ", [[1, 2], [3, 4]]), ("{}", []), ("{{},{}}", [[], []]),
        ("[0:1][2:3]={{1,2},{3,4}}", [[1, 2], [3, 4]]), ('{{"1"},{"2"}}', [[1], [2]]),
        ('{{1, "2" },{ "3" , NULL}}', [[1, 2], [3, None]]), ("{{1, },{2,3}}", None), ("{{1,2},{3}}", None), ("{1,2}", None), ("{{1,2},NULL}", None), ("{{{1}}}", None), ("{{1,x}}", None), ("{{1,2}", None),
        ("{{1,2}}}", None), ("{{1}{2}}", None), ("", None), (None, None),
    ]
    assert parsed(spark, [c[0] for c in cases], two) == [c[1] for c in cases]
    deep = [
        ('{{{a,"}"},{"{",NULL}},{{"x\\"y",c d},{",",""}}}', [[["a", "}"], ["{", None]], [['x"y', "c d"], [",", ""]]]),
        ("{{{a}},{{b}}}", [[["a"]], [["b"]]]), ("{{{a,b}},{{c}}}", None), ("{{{a}},{{b},{c}}}", None), ("{{a}}", None),
    ]
    assert parsed(spark, [c[0] for c in deep], three) == [c[1] for c in deep]


def test_long_arrays_need_no_stack(spark):
    text = "{" + ",".join(["{" + ",".join(str(k) for k in range(300)) + "}"] * 200) + "}"
    (found,) = parsed(spark, [text], spark_type("integer[][]"))
    assert len(found) == 200 and found[7] == list(range(300))


def test_composites(spark):
    assert composite_fields("composite(a integer, b numeric(10,2),c text[])") == [("a", "integer"), ("b", "numeric(10,2)"), ("c", "text[]")]
    with pytest.raises(ValueError):
        composite_fields("composite(a)")
    target = spark_type("composite(a integer,b text,c numeric(10,2))")
    cases = [
        ('(1,"b,c",)', (1, "b,c", None)), ("(,,)", (None, None, None)), ('(2,"",3.5)', (2, "", 3.5)), ('(3,"say ""hi"" \\\\ \\"x\\"",1)', (3, 'say "hi" \\ "x"', 1)),
        ("(4,plain text,1)", (4, "plain text", 1)), ('(5,a"b c"d,1)', (5, "ab cd", 1)), ("(x,b,1)", None), ("(1,b)", None), ("(1,b,1,2)", None), ("1,b,1", None), ('(1,"b,1)', None), (None, None),
    ]
    got = parsed(spark, [c[0] for c in cases], target)
    assert [g and tuple(g) for g in got] == [c[1] for c in cases]
    nested = spark_type("composite(a integer,p composite(x integer,y text[]))")
    (row, bad) = parsed(spark, ['(1,"(2,""{u,\\"v w\\"}"")")', '(1,"(z,)")'], nested)
    assert row.p.x == 2 and row.p.y == ["u", "v w"] and bad is None


def test_round_trip_and_rejects(spark):
    rules = (CastRule("grid", "text[][]"), CastRule("pair", "composite(a integer,b text)"))
    columns = (ColumnSpec("g", "grid"), ColumnSpec("p", "pair"))
    rows = [('{{a,"b c"},{NULL,"{}"}}', '(1,"x, ""y"" \\\\")'), ("{{a},{b,c}}", "(1,)"), (None, "(oops,)"), ("{}", None)]
    raw = spark.createDataFrame(rows, "g string, p string")
    out = cast_table(raw, columns, "pgsql", rules)
    errors = [r[ERRORS] and [(e.column, e.reason) for e in r[ERRORS]] for r in out.collect()]
    assert errors[0] is None and errors[3] is None and errors[1][0][0] == "g" and errors[2][0][0] == "p"
    good = out.filter(F.col(ERRORS).isNull()).drop(ERRORS)
    lines = [r.value for r in encode_copy_text(good).collect()]
    assert lines[0] == '{{"a","b c"},{NULL,"{}"}}\t(1,"x, ""y"" \\\\\\\\")' and lines[1] == "{}\t\\N"
    text = spark.createDataFrame([tuple(c.replace("\\\\", "\\") for c in lines[0].split("\t"))], "g string, p string")
    again = cast_table(text, columns, "pgsql", rules).drop(ERRORS)
    assert again.first() == good.first()
