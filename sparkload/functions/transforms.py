"""Named value transforms as Column expressions.

Every transform has the signature ``(column, data_type) -> column`` and keeps NULL
as NULL. ``data_type`` is the Spark type of the incoming column, so that the
expression holds only the branch it needs. ``TRANSFORMS`` maps the names used in
cast rules to the functions; ``register`` adds a user's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import trim_space

Transform = Callable[[Column, T.DataType], Column]

STRING = T.StringType()
BINARY = T.BinaryType()


def _is_text(dt: T.DataType) -> bool:
    return isinstance(dt, T.StringType)


def _is_binary(dt: T.DataType) -> bool:
    return isinstance(dt, T.BinaryType)


def _is_number(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def _bytes_as_chars(c: Column) -> Column:
    """One character per byte, and back with ``_chars_as_bytes``."""
    return F.decode(c, "ISO-8859-1")


def _chars_as_bytes(c: Column) -> Column:
    return F.encode(c, "ISO-8859-1")


# --- booleans ------------------------------------------------------------------------


def tinyint_to_bool(c: Column, dt: T.DataType = STRING) -> Column:
    """0 or '0' is false, every other value true."""
    if _is_number(dt):
        return c != 0
    if _is_text(dt):
        return c != "0"
    if _is_binary(dt):
        return F.hex(c) != "30"
    return c


def bit_to_bool(c: Column, dt: T.DataType = BINARY) -> Column:
    """Bytes: exactly one zero byte is false. Text: a leading NUL is false."""
    if _is_binary(dt):
        return F.hex(c) != "00"
    if _is_text(dt):
        return ~F.startswith(c, F.lit("\u0000"))
    if _is_number(dt):
        return c != 0
    return c


def mssql_bit_to_boolean(c: Column, dt: T.DataType = STRING) -> Column:
    """0, false, '0', 'false' and a leading zero byte are false."""
    if _is_number(dt):
        return c != 0
    if _is_text(dt):
        return ~c.isin("0", "false")
    if _is_binary(dt):
        return F.substring(F.hex(c), 1, 2) != "00"
    return c


# --- dates, text ---------------------------------------------------------------------

# The texts of a zero date.
ZERO_DATES = ("0000-00-00", "0000-00-00 00:00:00")


def zero_dates_to_null(c: Column, dt: T.DataType = STRING) -> Column:
    if _is_text(dt):
        return F.when(~c.isin(*ZERO_DATES), c)
    if _is_binary(dt):
        return F.when(~_bytes_as_chars(c).isin(*ZERO_DATES), c)
    return c


def remove_null_chars(c: Column, dt: T.DataType = STRING) -> Column:
    nul, nothing = F.lit("\u0000"), F.lit("")
    if _is_text(dt):
        return F.replace(c, nul, nothing)
    if _is_binary(dt):
        return _chars_as_bytes(F.replace(_bytes_as_chars(c), nul, nothing))
    return c


def int_to_id(c: Column, dt: T.DataType = STRING) -> Column:
    return c


def sanitize_utf8(c: Column, dt: T.DataType = STRING) -> Column:
    """Invalid UTF-8 sequences become U+FFFD; bytes come out as text."""
    if _is_binary(dt):
        return F.make_valid_utf8(c.cast("string"))
    return F.make_valid_utf8(c) if _is_text(dt) else c


# --- bits and bytes ------------------------------------------------------------------


def bit_to_binstr(c: Column, dt: T.DataType = BINARY, bits: int | None = None) -> Column:
    """Eight 0/1 characters per byte, most significant first; empty gives '0'.

    With ``bits`` only the rightmost ``bits`` characters stay, as ``bit(n)`` needs.
    """
    if not (_is_binary(dt) or _is_text(dt)):
        return c
    # Hex digits move to letters first, so that the 0s and 1s put in are never replaced again.
    text = F.translate(F.hex(c), "0123456789ABCDEF", "abcdefghijklmnop")
    for value, letter in enumerate("abcdefghijklmnop"):
        text = F.replace(text, F.lit(letter), F.lit(format(value, "04b")))
    text = F.when(text == "", F.lit("0")).otherwise(text)
    return F.right(text, F.lit(bits)) if bits else text


def byte_vector_to_bytea(c: Column, dt: T.DataType = BINARY) -> Column:
    r"""Bytes as ``\x`` and lower-case hex; text stays."""
    return F.concat(F.lit("\\x"), F.lower(F.hex(c))) if _is_binary(dt) else c


def uniqueidentifier_to_uuid(c: Column, dt: T.DataType = STRING) -> Column:
    """Canonical UUID text; the first three groups of 16 raw bytes are little-endian."""

    def clean(text: Column) -> Column:
        return F.lower(F.regexp_replace(trim_space(text), r"^\{?\(?|\)?\}?$", ""))

    if _is_text(dt):
        return clean(c)
    if not _is_binary(dt):
        return c
    swapped = F.regexp_replace(
        F.lower(F.hex(c)),
        "^(..)(..)(..)(..)(..)(..)(..)(..)(....)(.{12})$",
        "$4$3$2$1-$6$5-$8$7-$9-$10",
    )
    return F.when(F.octet_length(c) == 16, swapped).otherwise(clean(c.cast("string")))


# --- geometry, money, floats ---------------------------------------------------------


# A point of exactly two coordinates.
POINT = r"(?s)^POINT\(\s*(\S+)\s+(\S+)\s*\)$"


def wkt_to_geometry(c: Column, dt: T.DataType = STRING) -> Column:
    """``POINT(x y)`` -> ``(x,y)``; ``LINESTRING(x y, ...)`` -> ``((x,y),...)``; else unchanged."""
    if not _is_text(dt):
        return c
    text = trim_space(c)
    # Blanks around the commas go first; then every point of two fields becomes a pair.
    inner = trim_space(F.substr(text, F.lit(12), F.length(text) - 12))
    points = F.regexp_replace(inner, r"\s*,\s*", ",")
    pairs = F.regexp_replace(points, r"(?<=^|,)([^\s,]+)\s+([^\s,]+)(?=,|$)", "($1,$2)")
    is_point = F.startswith(text, F.lit("POINT(")) & text.rlike(POINT)
    is_line = F.startswith(text, F.lit("LINESTRING(")) & F.endswith(text, F.lit(")"))
    return (
        F.when(is_point, F.regexp_replace(text, POINT, "($1,$2)"))
        .when(is_line, F.concat(F.lit("("), pairs, F.lit(")")))
        .otherwise(c)
    )


# Money text is negative in parentheses or with a minus before its first digit.
NEGATIVE_MONEY = r"(?s)^\(.*\)$|^[^0-9]*-[^0-9]*[0-9]"
# Only one kind of separator, several times: it groups thousands.
GROUPED_ONLY = r"^[0-9]*(,[0-9]*){2,}$|^[0-9]*(\.[0-9]*){2,}$"
# Dollars and cents, with commas only where a point follows and so shows what they are.
DOLLARS = r"^-?\$?([0-9]+|[0-9]{1,3}(,[0-9]{3})+(?=\.))(\.[0-9]+)?$"
# A separator of the other kind than the last one.
NOT_LAST_SEPARATOR = r"\.(?=.*,[0-9]*$)|,(?=.*\.[0-9]*$)"


def money_to_numeric(c: Column, dt: T.DataType = STRING) -> Column:
    """Formatted money text as plain numeric text.

    Parentheses or a minus before the first digit mean negative. With both separators
    the last one is the decimal point; a separator that is alone is one too, unless it
    occurs several times and so must group thousands.
    """
    if _is_binary(dt):
        c, dt = c.cast("string"), STRING
    if not _is_text(dt):
        return c
    text = trim_space(c)
    digits = F.regexp_replace(text, "[^0-9.,]", "")
    # Every step names its input as few times as it can: expressions are inlined, so a
    # value used twice at each of five steps would be computed 32 times.
    plain = F.when(digits.rlike(GROUPED_ONLY), F.translate(digits, ".,", "")).otherwise(
        F.translate(F.regexp_replace(digits, NOT_LAST_SEPARATOR, ""), ",", ".")
    )
    sign = F.when(text.rlike(NEGATIVE_MONEY), F.lit("-")).otherwise(F.lit(""))
    general = F.concat(sign, F.regexp_replace(plain, "^$", "0"))
    # The common notation needs one pattern only.
    return F.when(c.rlike(DOLLARS), F.translate(c, "$,", "")).when(c == "", c).otherwise(general)


def float_to_string(c: Column, dt: T.DataType = STRING) -> Column:
    """Text that reads back to the same value."""
    return c if _is_text(dt) else c.cast("string")


# --- values as a driver would hand them over -----------------------------------------


def normalize_value(c: Column, dt: T.DataType, dialect: str) -> Column:
    """Widen narrow numbers, booleans to 0/1 and times to text, by source dialect."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
        return c.cast("bigint")
    if isinstance(dt, T.FloatType):
        return c.cast("double")
    if isinstance(dt, T.BooleanType) and dialect in ("sqlite", "mssql"):
        return c.cast("bigint")
    if isinstance(dt, T.TimestampType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSSx")
    if isinstance(dt, T.TimestampNTZType):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return c


def normalized_type(dt: T.DataType, dialect: str) -> T.DataType:
    """The type that ``normalize_value`` gives."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(dt, T.FloatType):
        return T.DoubleType()
    if isinstance(dt, T.BooleanType) and dialect in ("sqlite", "mssql"):
        return T.LongType()
    return STRING if isinstance(dt, (T.TimestampType, T.TimestampNTZType)) else dt


# --- registry ------------------------------------------------------------------------

TRANSFORMS: dict[str, Transform] = {
    "tinyint-to-bool": tinyint_to_bool,
    "zero-dates-to-null": zero_dates_to_null,
    "remove-null-chars": remove_null_chars,
    "int-to-id": int_to_id,
    "bit-to-bool": bit_to_bool,
    "wkt-to-geometry": wkt_to_geometry,
    "bit-to-binstr": bit_to_binstr,
    "money-to-numeric": money_to_numeric,
    "sql-server-bit-to-boolean": mssql_bit_to_boolean,
    "sql-server-uniqueidentifier-to-uuid": uniqueidentifier_to_uuid,
    "float-to-string": float_to_string,
    "byte-vector-to-bytea": byte_vector_to_bytea,
}


def register(name: str, transform: Transform) -> None:
    """Make a user's transform available to cast rules."""
    TRANSFORMS[name] = transform


def apply_transform(name: str | None, c: Column, dt: T.DataType) -> Column:
    """The named transform on ``c``; no name or an unknown one leaves the value alone."""
    transform = TRANSFORMS.get(name) if name else None
    return transform(c, dt) if transform else c
