"""Cast rules: the four default rule lists, matching and typemod handling."""

from __future__ import annotations

import re
from dataclasses import dataclass

from ..model import CastRule, ColumnSpec

# --- fixed values: default cast rules, first match wins -----------------------------

MYSQL_RULES = (
    CastRule("bit", "boolean", type_mod="(1)", drop_typemod=True, transform="bit-to-bool"),
    CastRule("bit", "bit varying($mod)", transform="bit-to-binstr"),
    CastRule("tinyint", "boolean", type_mod="(1)", drop_typemod=True, transform="tinyint-to-bool"),
    # The unsigned rule stands before the plain one: a 32-bit serial cannot hold it.
    CastRule("int", "bigserial", unsigned=True, auto_increment=True, drop_typemod=True, transform="int-to-id"),
    CastRule("int", "serial", auto_increment=True, drop_typemod=True, transform="int-to-id"),
    CastRule("bigint", "bigserial", auto_increment=True, drop_typemod=True, transform="int-to-id"),
    CastRule("mediumint", "serial", auto_increment=True, drop_typemod=True),
    CastRule("smallint", "serial", auto_increment=True, drop_typemod=True),
    CastRule("tinyint", "serial", auto_increment=True, drop_typemod=True),
    CastRule("tinyint", "smallint", unsigned=True, drop_typemod=True),
    CastRule("smallint", "integer", unsigned=True, drop_typemod=True),
    CastRule("mediumint", "integer", unsigned=True, drop_typemod=True),
    CastRule("int", "bigint", unsigned=True, drop_typemod=True),
    CastRule("bigint", "numeric(20)", unsigned=True, drop_typemod=True),
    CastRule("tinyint", "smallint", drop_typemod=True),
    CastRule("smallint", "smallint", drop_typemod=True),
    CastRule("mediumint", "integer", drop_typemod=True),
    CastRule("int", "integer", drop_typemod=True),
    CastRule("integer", "integer", drop_typemod=True),
    CastRule("bigint", "bigint", drop_typemod=True),
    CastRule("float", "float"),
    CastRule("double", "double precision"),
    CastRule("real", "float"),
    CastRule("decimal", "numeric($mod)"),
    CastRule("numeric", "numeric($mod)"),
    CastRule("dec", "numeric($mod)"),
    CastRule("fixed", "numeric($mod)"),
    CastRule("char", "char($mod)"),
    CastRule("varchar", "varchar($mod)"),
    CastRule("tinytext", "text", drop_typemod=True, transform="remove-null-chars"),
    CastRule("text", "text", drop_typemod=True, transform="remove-null-chars"),
    CastRule("mediumtext", "text", drop_typemod=True, transform="remove-null-chars"),
    CastRule("longtext", "text", drop_typemod=True, transform="remove-null-chars"),
    CastRule("binary", "bytea", drop_typemod=True),
    CastRule("varbinary", "bytea", drop_typemod=True),
    CastRule("tinyblob", "bytea", drop_typemod=True),
    CastRule("blob", "bytea", drop_typemod=True),
    CastRule("mediumblob", "bytea", drop_typemod=True),
    CastRule("longblob", "bytea", drop_typemod=True),
    CastRule("datetime", "timestamptz", drop_typemod=True, transform="zero-dates-to-null"),
    CastRule("timestamp", "timestamptz", drop_typemod=True, transform="zero-dates-to-null"),
    CastRule("date", "date", drop_typemod=True, transform="zero-dates-to-null"),
    CastRule("time", "time", drop_typemod=True),
    CastRule("year", "smallint", drop_typemod=True),
    CastRule("enum", "text", drop_typemod=True),
    CastRule("set", "text", drop_typemod=True),
    CastRule("json", "jsonb", drop_typemod=True),
    CastRule("geometry", "geometry", drop_typemod=True, transform="wkt-to-geometry"),
    CastRule("point", "point", drop_typemod=True, transform="wkt-to-geometry"),
    CastRule("linestring", "path", drop_typemod=True, transform="wkt-to-geometry"),
    CastRule("polygon", "polygon", drop_typemod=True),
    CastRule("serial", "integer", drop_typemod=True),
    CastRule("bigserial", "bigint", drop_typemod=True),
)

MSSQL_RULES = (
    CastRule("char", "text", drop_typemod=True),
    CastRule("nchar", "text", drop_typemod=True),
    CastRule("varchar", "text", drop_typemod=True),
    CastRule("nvarchar", "text", drop_typemod=True),
    CastRule("ntext", "text", drop_typemod=True),
    CastRule("xml", "xml", drop_typemod=True),
    CastRule("int", "bigserial", auto_increment=True, drop_typemod=True),
    CastRule("bigint", "bigserial", auto_increment=True, drop_typemod=True),
    CastRule("smallint", "smallserial", auto_increment=True, drop_typemod=True),
    CastRule("tinyint", "serial", auto_increment=True, drop_typemod=True),
    CastRule("tinyint", "smallint", drop_typemod=True),
    CastRule("smallint", "smallint", drop_typemod=True),
    CastRule("int", "integer", drop_typemod=True),
    CastRule("bigint", "bigint", drop_typemod=True),
    CastRule("bit", "boolean", drop_typemod=True, transform="sql-server-bit-to-boolean"),
    CastRule("uniqueidentifier", "uuid", drop_typemod=True, transform="sql-server-uniqueidentifier-to-uuid"),
    CastRule("hierarchyid", "bytea", drop_typemod=True, transform="byte-vector-to-bytea"),
    CastRule("geography", "bytea", drop_typemod=True, transform="byte-vector-to-bytea"),
    CastRule("float", "float", transform="float-to-string"),
    CastRule("real", "real", transform="float-to-string"),
    CastRule("double", "double precision", drop_typemod=True, transform="float-to-string"),
    CastRule("numeric", "numeric", transform="float-to-string"),
    CastRule("decimal", "numeric", transform="float-to-string"),
    CastRule("money", "numeric", drop_typemod=True, transform="float-to-string"),
    CastRule("smallmoney", "numeric", drop_typemod=True, transform="float-to-string"),
    CastRule("binary", "bytea", drop_typemod=True, transform="byte-vector-to-bytea"),
    CastRule("varbinary", "bytea", drop_typemod=True, transform="byte-vector-to-bytea"),
    CastRule("image", "bytea", drop_typemod=True, transform="byte-vector-to-bytea"),
    CastRule("smalldatetime", "timestamptz", drop_typemod=True),
    CastRule("datetime", "timestamptz", drop_typemod=True),
    CastRule("datetime2", "timestamptz", drop_typemod=True),
    CastRule("datetimeoffset", "timestamptz", drop_typemod=True),
)

SQLITE_RULES = (
    CastRule("integer", "bigserial", auto_increment=True, drop_typemod=True, transform="int-to-id"),
    CastRule("integer", "bigint", drop_typemod=True),
    CastRule("tinyint", "smallint", drop_typemod=True),
    CastRule("smallint", "smallint", drop_typemod=True),
    CastRule("mediumint", "integer", drop_typemod=True),
    CastRule("bigint", "bigint", drop_typemod=True),
    CastRule("int", "integer", drop_typemod=True),
    CastRule("real", "real", drop_typemod=True),
    CastRule("float", "float", drop_typemod=True),
    CastRule("double", "double precision", drop_typemod=True),
    CastRule("numeric", "numeric($mod)"),
    CastRule("decimal", "decimal($mod)"),
    CastRule("text", "text", drop_typemod=True),
    CastRule("varchar", "text", drop_typemod=True),
    CastRule("nvarchar", "text", drop_typemod=True),
    CastRule("char", "text", drop_typemod=True),
    CastRule("nchar", "text", drop_typemod=True),
    CastRule("clob", "text", drop_typemod=True),
    CastRule("blob", "bytea", drop_typemod=True),
    CastRule("boolean", "boolean", drop_typemod=True),
    CastRule("bool", "boolean", drop_typemod=True),
    CastRule("datetime", "timestamptz", drop_typemod=True, transform="zero-dates-to-null"),
    CastRule("timestamp", "timestamp", drop_typemod=True),
    CastRule("date", "date", drop_typemod=True),
    CastRule("time", "time", drop_typemod=True),
)

PGSQL_RULES = (
    CastRule("money", "numeric", drop_typemod=True, transform="money-to-numeric"),
    CastRule("txid_snapshot", "text", drop_typemod=True),
    CastRule("pg_lsn", "text", drop_typemod=True),
    CastRule("oid", "oid", drop_typemod=True),
    CastRule("regclass", "regclass", drop_typemod=True),
    CastRule("regproc", "regproc", drop_typemod=True),
    CastRule("regprocedure", "regprocedure", drop_typemod=True),
    CastRule("regoper", "regoper", drop_typemod=True),
    CastRule("regoperator", "regoperator", drop_typemod=True),
    CastRule("regtype", "regtype", drop_typemod=True),
    CastRule("regrole", "regrole", drop_typemod=True),
    CastRule("regnamespace", "regnamespace", drop_typemod=True),
    CastRule("regconfig", "regconfig", drop_typemod=True),
    CastRule("regdictionary", "regdictionary", drop_typemod=True),
    CastRule("xid", "bigint", drop_typemod=True),
    CastRule("cid", "bigint", drop_typemod=True),
    CastRule("tid", "tid", drop_typemod=True),
    CastRule("pg_node_tree", "text", drop_typemod=True),
    CastRule("aclitem", "text", drop_typemod=True),
)

# --- end of fixed values -------------------------------------------------------------

DEFAULT_RULES = {
    "mysql": MYSQL_RULES,
    "mssql": MSSQL_RULES,
    "sqlite": SQLITE_RULES,
    "pgsql": PGSQL_RULES,
}


def with_user_rules(user_rules, dialect: str) -> tuple[CastRule, ...]:
    """User rules first, then the dialect's defaults: declared order is the contract."""
    return tuple(user_rules) + DEFAULT_RULES[dialect]


# --- typemod helpers -----------------------------------------------------------------


def parse_typemod(column_type: str) -> str:
    """Text between the first '(' and the last ')', or ''."""
    match = re.search(r"\((.*)\)", column_type, re.DOTALL)
    return match.group(1) if match else ""


def typemod_params(mod: str) -> tuple[int, int]:
    """'18,6' -> (18, 6); '255' -> (255, 0); anything unreadable counts as 0."""
    numbers = [p.strip() for p in mod.split(",", 1)] + ["", ""]
    precision, scale = (int(p) if re.fullmatch(r"[+-]?\d+", p) else 0 for p in numbers[:2])
    return precision, scale


def base_type(column_type: str) -> str:
    """'tinyint(1) unsigned' -> 'tinyint'."""
    without_sign = re.sub(r"(?<=.) (?:un)?signed.*", "", column_type.strip(), flags=re.DOTALL)
    return re.sub(r"(?<=.)\(.*", "", without_sign, flags=re.DOTALL).strip()


def substitute_typemod(target: str, mod: str) -> str:
    """Fill in ``$mod``; with no typemod the empty parentheses go as well."""
    if mod == "":
        return target.replace("($mod)", "").replace("$mod", "")
    return target.replace("$mod", mod)


def mssql_column_type(name: str, precision=0, scale=0, char_length=0, datetime_precision=0) -> str:
    """Full SQL Server type text from its information-schema numbers."""
    if name in ("float", "real"):
        mod = str(precision) if precision > 0 else ""
    elif name in ("decimal", "numeric"):
        mod = ",".join(str(n) for n in (precision, scale) if n > 0) if precision > 0 else ""
    elif name in ("char", "nchar", "varchar", "nvarchar", "binary"):
        mod = str(char_length) if char_length > 0 else ""  # -1 stands for "max"
    elif name in ("smalldatetime", "datetime"):
        mod = str(datetime_precision) if datetime_precision > 0 else ""
    else:
        mod = ""
    return f"{name}({mod})" if mod else name


# --- rule resolution -----------------------------------------------------------------


@dataclass(frozen=True)
class Resolved:
    target: str
    drop_typemod: bool = False
    transform: str | None = None


def rule_matches(rule: CastRule, column_type: str, extra: str = "") -> bool:
    wanted = (
        (rule.unsigned, "unsigned" in column_type),
        (rule.auto_increment, "auto_increment" in extra),
        (rule.on_update, "on update CURRENT_TIMESTAMP" in extra),
    )
    return (
        (not rule.source_type or rule.source_type.lower() == base_type(column_type).lower())
        and rule.type_mod in column_type
        and all(want is None or want == has for want, has in wanted)
    )


def resolve(rules, column: ColumnSpec) -> Resolved:
    """First matching rule with its typemod filled in; no match keeps the type's own name."""
    mod = parse_typemod(column.source_type)
    for rule in rules:
        if rule_matches(rule, column.source_type, column.extra):
            return Resolved(
                substitute_typemod(rule.target, "" if rule.drop_typemod else mod),
                rule.drop_typemod,
                rule.transform,
            )
    # Words after the typemod stay: "timestamp(3) with time zone" names one type.
    return Resolved(base_type(re.sub(r"\s*\(.*?\)", "", column.source_type)).lower())
