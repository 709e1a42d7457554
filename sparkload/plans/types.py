"""Target type names -> Spark types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

from ..model import ColumnSpec
from .rules import Resolved, parse_typemod, resolve, typemod_params

MAX_PRECISION = 38

# Target type names without parameters.
_PLAIN = {
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "smallint": T.ShortType(),
    "int2": T.ShortType(),
    "smallserial": T.ShortType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "int4": T.IntegerType(),
    "serial": T.IntegerType(),
    "bigint": T.LongType(),
    "int8": T.LongType(),
    "bigserial": T.LongType(),
    "real": T.FloatType(),
    "float4": T.FloatType(),
    "float": T.DoubleType(),
    "float8": T.DoubleType(),
    "double precision": T.DoubleType(),
    "bytea": T.BinaryType(),
    "date": T.DateType(),
    "timestamptz": T.TimestampType(),
    "timestamp with time zone": T.TimestampType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "json": T.VariantType(),
    "jsonb": T.VariantType(),
    "oid": T.LongType(),
    "xid": T.LongType(),
    "cid": T.LongType(),
}

# Types whose values stay text on Spark.
_TEXT = (
    "text", "varchar", "character varying", "char", "character", "bpchar", "name",
    "time", "time without time zone", "timetz", "time with time zone", "xml", "uuid", "bit", "bit varying",
    "geometry", "point", "path", "polygon", "multipoint", "multilinestring", "multipolygon",
    "geometrycollection", "line", "lseg", "box", "circle",
    "tid", "pg_lsn", "txid_snapshot", "pg_node_tree", "aclitem",
    "regclass", "regproc", "regprocedure", "regoper", "regoperator", "regtype",
    "regrole", "regnamespace", "regconfig", "regdictionary",
    "inet", "cidr", "macaddr", "tsvector",
)

LENGTH_LIMITED = ("varchar", "character varying", "char", "character", "bpchar")


def is_composite(target: str) -> bool:
    return re.match(r"(?i)\s*composite\s*\(", target) is not None and target.rstrip().endswith(")")


def composite_fields(target: str) -> list[tuple[str, str]]:
    """'composite(a integer,b numeric(10,2))' -> its fields with their types."""
    inner, depth, fields, begin = parse_typemod(target), 0, [], 0
    for i, c in enumerate(inner + ","):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            name, _, kind = inner[begin:i].strip().partition(" ")
            if not kind.strip():
                raise ValueError(f"no type for field {name!r} of {target!r}")
            fields.append((name, kind.strip()))
            begin = i + 1
    return fields


def type_name(target: str) -> str:
    """'numeric(10,2)' -> 'numeric'."""
    if is_composite(target):
        return "composite"
    return re.sub(r"\s*\(.*?\)", "", target).strip().lower()


def decimal_type(mod: str) -> T.DecimalType:
    precision, scale = typemod_params(mod)
    if not 0 < precision <= MAX_PRECISION or not 0 <= scale <= precision:
        raise ValueError(f"numeric({mod}) does not fit a decimal of {MAX_PRECISION} digits")
    return T.DecimalType(precision, scale)


def spark_type(target: str, source_type: str = "", labels: tuple[str, ...] = (), refuse_unlisted: bool = False) -> T.DataType:
    """Spark type of a resolved target type.

    ``source_type`` supplies the typemod of a bare ``numeric``. A type name that is
    not known, or none at all, means text; with ``refuse_unlisted`` an unknown name is an error
    unless ``labels`` say that it is an enum.
    """
    if target.endswith("[]"):
        return T.ArrayType(spark_type(target[:-2], refuse_unlisted=refuse_unlisted))
    if is_composite(target):
        fields = composite_fields(target)
        return T.StructType([T.StructField(n, spark_type(t, refuse_unlisted=refuse_unlisted)) for n, t in fields])
    name = type_name(target)
    if name in ("numeric", "decimal"):
        mod = parse_typemod(target)
        if mod:
            return decimal_type(mod)
        source = type_name(source_type)
        if source in ("money", "smallmoney"):
            return T.DecimalType(19, 4)
        if parse_typemod(source_type) and source in ("numeric", "decimal"):
            return decimal_type(parse_typemod(source_type))
        return T.DecimalType(38, 10)
    if name in _PLAIN:
        return _PLAIN[name]
    if not refuse_unlisted or not name or name in _TEXT or labels:
        return T.StringType()
    raise ValueError(f"no Spark type for target type {target!r}")


def target_field(column: ColumnSpec, rules, refuse_unlisted: bool = False) -> tuple[T.StructField, Resolved]:
    """The target column as a StructField, with what Spark cannot type kept as metadata."""
    resolved = resolve(rules, column)
    metadata = {"source_type": column.source_type, "target_type": resolved.target}
    if column.auto_increment:
        metadata["auto_increment"] = True
    if column.comment:
        metadata["comment"] = column.comment
    data_type = spark_type(resolved.target, column.source_type, column.labels, refuse_unlisted)
    if type_name(column.source_type) == "money" and resolved.transform == "money-to-numeric":
        # A 64-bit money value in cents has 17 digits before the point.
        data_type = T.DecimalType(21, 4)
    return T.StructField(column.name, data_type, column.nullable, metadata), resolved
