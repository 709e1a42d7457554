"""Array and composite literals: ``{{1,2},{3,NULL}}`` and ``(a,"b,c",)`` as typed values, and composites as text.

The depth of nesting is that of the target type, so a pattern for each depth is built from the one below it. A literal
is held against its pattern as a whole, then cut into the pieces of the next depth. Everything is an expression on
built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import transforms as tf

# An array item: quoted with backslash escapes, or plain. Spaces around it do not count.
ARRAY_ITEM = r'"(?:[^"\\]|\\.)*+"|[^,"{}\s][^,"{}]*+'
# A composite field: nothing (NULL), or quoted and plain parts; a quote within quotes is doubled or escaped.
FIELD = r'(?:"(?:[^"\\]|\\.|"")*+"|[^,()"\\]|\\.)*+'
# Bounds other than from 1 are written ahead of the array.
BOUNDS = r"^\s*(?:\[[+-]?\d+:[+-]?\d+\])+\s*=\s*"


def depth_of(target: T.DataType) -> int:
    return 1 + depth_of(target.elementType) if isinstance(target, T.ArrayType) else 0


def array_pattern(depth: int) -> str:
    """One array of a depth; loops are possessive, so long arrays need no stack."""
    item = f"(?:{ARRAY_ITEM})"
    for _ in range(depth):
        item = rf"\{{\s*(?:{item}\s*(?:,\s*{item}\s*)*+)?\}}"
    return item


def array_literal(v: Column, target: T.ArrayType) -> Column:
    """``{a,"b c",NULL}`` -> array; NULL when an element does not fit or nesting is not that of the target.

    Nested arrays must be of one length on each level, as the target database wants them, and are never NULL.
    """
    text = F.regexp_replace(tf.trim_space(v), BOUNDS, "")
    value = _array(text, target)
    return F.when(text.rlike(f"(?s)^{array_pattern(depth_of(target))}$"), value)


def _array(text: Column, target: T.ArrayType) -> Column:
    body = F.substr(text, F.lit(2), F.length(text) - 2)
    empty = text.rlike(r"^\{\s*\}$")
    none = F.array().cast(target)
    element = target.elementType
    if isinstance(element, T.ArrayType):
        # Without quotes, pieces of the innermost depth but one end at every closing brace.
        pieces = F.regexp_extract_all(body, F.lit(f"(?s){array_pattern(depth_of(element))}"), F.lit(0))
        inner = F.transform(pieces, lambda e: _array(e, element))
        whole = ~F.exists(inner, lambda e: e.isNull()) & (F.size(F.array_distinct(F.transform(inner, lambda e: F.size(e)))) <= 1)
        return F.when(empty, none).otherwise(F.transform(F.array(inner), lambda x: F.when(_rectangular(x), x))[0] if depth_of(element) > 1 else F.when(whole, inner))
    items = F.when(F.contains(text, F.lit('"')), F.regexp_extract_all(body, F.lit("(?s)" + ARRAY_ITEM), F.lit(0))).otherwise(
        F.split(body, ",")
    )

    def item_text(e: Column) -> Column:
        inside = F.regexp_replace(F.regexp_replace(tf.trim_space(e), '^"|"$', ""), r"(?s)\\(.)", "$1")
        plain = F.when(F.upper(tf.trim_space(e)) != "NULL", tf.trim_space(e))
        return F.when(F.contains(e, F.lit('"')), inside).otherwise(plain)

    values = texts = F.transform(items, item_text)
    if not isinstance(element, T.StringType):
        typed = F.transform(texts, lambda e: F.struct(e.isNotNull().alias("given"), e.try_cast(element).alias("v")))
        fits = ~F.exists(typed, lambda e: e["given"] & e["v"].isNull())
        values = F.when(fits, F.transform(typed, lambda e: e["v"]))
    return F.when(empty, none).otherwise(values)


def _rectangular(x: Column) -> Column:
    """Whether arrays of arrays are all there and their own arrays of one length throughout."""
    inner = F.flatten(x)
    return (
        ~F.exists(x, lambda e: e.isNull())
        & (F.size(F.array_distinct(F.transform(x, lambda e: F.size(e)))) <= 1)
        & (F.size(F.array_distinct(F.transform(inner, lambda e: F.size(e)))) <= 1)
    )


def composite_literal(v: Column, target: T.StructType) -> Column:
    """``(1,"b,c",)`` -> struct; NULL when the number of fields or one of them does not fit."""
    text = tf.trim_space(v)
    pattern = r"(?s)^\(" + ",".join([f"({FIELD})"] * len(target.fields)) + r"\)$"

    def field_text(i: int) -> Column:
        raw = F.regexp_extract(text, pattern, i + 1)
        inside = F.regexp_replace(raw, r'(?s)"((?:[^"\\]|\\.|"")*+)"', "$1")
        return F.when(raw != "", F.regexp_replace(inside, r'(?s)\\(.)|"(")', "$1$2"))

    def value(field: T.StructField, given: Column) -> Column:
        dt = field.dataType
        if isinstance(dt, T.StringType):
            return given
        if isinstance(dt, T.ArrayType):
            return array_literal(given, dt)
        if isinstance(dt, T.StructType):
            return composite_literal(given, dt)
        return tf.trim_space(given).try_cast(dt)

    texts = [field_text(i) for i in range(len(target.fields))]
    values = [value(f, t) for f, t in zip(target.fields, texts)]
    fits = text.rlike(pattern)
    for t, x in zip(texts, values):
        fits = fits & (t.isNull() | x.isNotNull())
    return F.when(fits, F.struct(*[x.alias(f.name) for f, x in zip(target.fields, values)]))


def composite_text(c: Column, dt: T.StructType, value_text) -> Column:
    """A struct as a composite literal; ``value_text`` gives the text of a field's value."""

    def field(f: T.StructField) -> Column:
        value = c[f.name]
        text = composite_text(value, f.dataType, value_text) if isinstance(f.dataType, T.StructType) else value_text(value, f.dataType)
        special = (text == "") | text.rlike(r'[\s,()"\\]')
        escaped = F.regexp_replace(text, r'(["\\])', "$1$1")
        return F.coalesce(F.when(special, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(text), F.lit(""))

    parts = [field(f) for f in dt.fields]
    joined = [x for p in parts for x in (F.lit(","), p)][1:]
    return F.when(c.isNotNull(), F.concat(F.lit("("), *joined, F.lit(")")))
