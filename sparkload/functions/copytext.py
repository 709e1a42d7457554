r"""The COPY text row format as Column expressions.

One line per row, TAB between fields, ``\N`` for NULL, backslash escapes for the
control characters. Both directions are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .literals import composite_text
from .text import quote

NULL_MARK = "\\N"
END_MARK = "\\."
DELIMITER = "\t"

# Character -> letter after the backslash. The backslash itself is first.
ESCAPES = (("\\", "\\"), ("\n", "n"), ("\r", "r"), ("\t", "t"), ("\b", "b"), ("\f", "f"), ("\v", "v"))


def escape_text(c: Column) -> Column:
    out = F.make_valid_utf8(c)
    for char, letter in ESCAPES:
        out = F.replace(out, F.lit(char), F.lit("\\" + letter))
    return out


def escape_string(c: Column) -> Column:
    """``escape_text`` for a plain column, fast where the newline is all there is to escape."""
    rare = F.lit(False)
    for char, _ in ESCAPES:
        if char != "\n":
            rare = rare | F.contains(c, F.lit(char))
    return F.when(rare, escape_text(c)).otherwise(F.replace(F.make_valid_utf8(c), F.lit("\n"), F.lit("\\n")))


def unescape_text(c: Column) -> Column:
    """Undo ``escape_text`` on a field; a backslash before any other character just goes away.

    A field holds no raw TAB, so a TAB can stand for an escaped backslash while the other
    escapes are undone. In the end a lone backslash stands for an escaped TAB, and both swap.
    """
    out = F.replace(c, F.lit("\\\\"), F.lit("\t"))
    for char, letter in ESCAPES:
        if char not in ("\\", "\t"):
            out = F.replace(out, F.lit("\\" + letter), F.lit(char))
    out = F.regexp_replace(out, r"\\(?!t)", "")
    out = F.replace(out, F.lit("\\t"), F.lit("\\"))
    swapped = F.translate(out, "\\\t", "\t\\")
    # Most fields hold no escape at all, or newlines only.
    return (
        F.when(~F.contains(c, F.lit("\\")), c)
        .when(~c.rlike(r"\\([^n]|$)"), F.replace(c, F.lit("\\n"), F.lit("\n")))
        .otherwise(swapped)
    )


def value_text(c: Column, dt: T.DataType) -> Column:
    """A value as the target's text input reads it, before escaping; NULL stays NULL."""
    if isinstance(dt, T.BooleanType):
        return F.when(c, F.lit("t")).when(~c, F.lit("f"))
    if isinstance(dt, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(c)))
    if isinstance(dt, T.TimestampType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")
    if isinstance(dt, T.ArrayType):
        return _array_text(c, dt)
    if isinstance(dt, (T.VariantType, T.StructType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def _array_text(c: Column, dt: T.ArrayType) -> Column:
    """Array literal; every non-NULL scalar element is quoted."""

    def element(e: Column) -> Column:
        if isinstance(dt.elementType, T.ArrayType):
            return F.coalesce(_array_text(e, dt.elementType), F.lit("NULL"))
        text = value_text(e, dt.elementType)
        for char in ("\\", '"'):
            text = F.replace(text, F.lit(char), F.lit("\\" + char))
        return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("NULL"))

    return F.concat(F.lit("{"), F.array_join(F.transform(c, element), ","), F.lit("}"))


def encode_value(c: Column, dt: T.DataType) -> Column:
    """One field of a COPY line, never NULL."""
    text = value_text(c, dt)
    if isinstance(dt, T.BinaryType):
        text = F.concat(F.lit("\\"), text)  # the only character to escape is the leading backslash
    elif isinstance(dt, T.StringType):
        text = escape_string(text)
    elif not isinstance(dt, (T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = escape_text(text)
    return F.coalesce(text, F.lit(NULL_MARK))


def encode_row(schema: T.StructType) -> Column:
    """The whole row as one line (without the newline)."""
    if not schema.fields:
        return F.lit("")
    return F.concat_ws(DELIMITER, *[_encode_field(f) for f in schema.fields])


def _encode_field(field: T.StructField) -> Column:
    """A struct is a composite literal where its target is a composite type, and JSON elsewhere."""
    c = F.col(quote(field.name))
    if isinstance(field.dataType, T.StructType) and field.metadata.get("target_type", "").lower().startswith("composite"):
        return F.coalesce(escape_text(composite_text(c, field.dataType, value_text)), F.lit(NULL_MARK))
    return encode_value(c, field.dataType)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of the encoded row with its newline, without building the row."""
    # A field is followed by a TAB or, the last one, by the newline.
    total = F.lit(max(1, len(schema.fields))).cast("bigint")
    for f in schema.fields:
        composite = isinstance(f.dataType, T.StructType)
        total = total + (F.octet_length(_encode_field(f)) if composite else _value_bytes(F.col(quote(f.name)), f.dataType))
    return total


def _value_bytes(c: Column, dt: T.DataType) -> Column:
    """Bytes of one encoded field, by arithmetic where the encoding need not be made."""
    null = F.lit(len(NULL_MARK))
    if isinstance(dt, T.BooleanType):
        return F.when(c.isNull(), null).otherwise(1)
    if isinstance(dt, T.BinaryType):
        return F.coalesce(F.octet_length(c) * 2 + 3, null)
    if isinstance(dt, T.StringType):
        # Each character to escape takes one byte more.
        text = F.make_valid_utf8(c)
        plain = F.translate(text, "".join(char for char, _ in ESCAPES), "")
        return F.coalesce(F.octet_length(text) * 2 - F.octet_length(plain), null)
    return F.octet_length(encode_value(c, dt))


def decode_field(field: Column) -> Column:
    return F.when(field != NULL_MARK, unescape_text(field))
