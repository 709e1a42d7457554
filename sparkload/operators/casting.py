"""Casting whole tables by rule, with row errors kept beside the row.

``cast_table`` is one projection of built-in expressions: no Python worker, no
shuffle, and a plan whose size depends on the number of columns only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import transforms as tf
from ..functions.literals import array_literal, composite_literal
from ..functions.text import quote
from ..model import ColumnSpec
from ..plans import rules as rl
from ..plans.types import LENGTH_LIMITED, target_field, type_name

ERRORS = "_errors"
ERROR_TYPE = "array<struct<column:string,value:string,reason:string>>"

# What the target's text input accepts.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
MODEST_NUMBER = r"^[+-]?([0-9]{1,28}(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9])?$"
SPECIAL_FLOATS = ("nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")
DATE_PATTERN = (
    r"^\s*[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}"
    r"([ T]\s*(([01]?[0-9]|2[0-3]):[0-5]?[0-9](:[0-5]?[0-9](\.[0-9]*)?)?|24:00(:00(\.0*)?)?)"
    r"\s*(Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2}(:?[0-9]{2})?)?)?)?\s*$"
)
TIME_PATTERN = r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9](:[0-5]?[0-9](\.[0-9]{1,6})?)?$|^24:00(:00(\.0{1,6})?)?$"
TIME_TARGETS = ("time", "time without time zone", "timetz", "time with time zone")
UUID_PATTERN = r"^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$"
TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")


@dataclass(frozen=True)
class CastPlan:
    """How one column is cast: its target field, transform and length limit."""

    column: ColumnSpec
    field: T.StructField
    target: str
    transform: str | None
    length: int | None


def plan_casts(columns, dialect: str, user_rules=(), refuse_unlisted: bool = False) -> list[CastPlan]:
    """Resolve every column once, on the driver; touches schema only.

    A type that no rule and no Spark type answers to is carried as text, with its name in the metadata, or is an
    error with ``refuse_unlisted``.
    """
    rules = rl.with_user_rules(user_rules, dialect)
    plans = []
    for column in columns:
        field, resolved = target_field(column, rules, refuse_unlisted)
        mod = rl.parse_typemod(resolved.target)
        if not mod and not resolved.drop_typemod:
            mod = rl.parse_typemod(column.source_type)
        name = type_name(resolved.target)
        limited = name in LENGTH_LIMITED or name in ("bit", "bit varying")
        length = rl.typemod_params(mod)[0] or None if limited else None
        plans.append(CastPlan(column, field, name, resolved.transform, length))
    return plans


def target_schema(columns, dialect: str, user_rules=()) -> T.StructType:
    return T.StructType([p.field for p in plan_casts(columns, dialect, user_rules)])


# --- one column ----------------------------------------------------------------------


def _prepared(plan: CastPlan, raw: Column, dt: T.DataType, dialect: str) -> Column:
    """Raw value -> transformed value, ready for the final cast."""
    target = plan.field.dataType
    if isinstance(target, T.BinaryType) and isinstance(dt, T.BinaryType):
        return raw  # bytes stay bytes, with no detour over hex text
    if plan.transform == "bit-to-binstr":
        return tf.bit_to_binstr(raw, dt, plan.length)
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        if isinstance(target, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return raw
        # Drivers hand over a year as a date and a time of day as a timestamp.
        if isinstance(target, T.IntegralType):
            return F.year(raw)
        if plan.target in TIME_TARGETS and not isinstance(dt, T.DateType):
            return F.date_format(raw, "HH:mm:ss.SSSSSS")
    return tf.apply_transform(
        plan.transform, tf.normalize_value(raw, dt, dialect), tf.normalized_type(dt, dialect)
    )


def _to_target(plan: CastPlan, v: Column, dt: T.DataType) -> Column:
    """Prepared value -> target type; NULL where the value is not acceptable."""
    target = plan.field.dataType
    if isinstance(dt, T.BinaryType) and not isinstance(target, T.BinaryType):
        # Bytes in a column of another type are text of unknown quality.
        v, dt = tf.sanitize_utf8(v, dt), T.StringType()
    is_text = isinstance(dt, T.StringType)
    if isinstance(target, T.BooleanType):
        if is_text:
            word = F.lower(tf.trim_space(v))
            return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
        if isinstance(dt, T.NumericType):
            return F.when(v == 1, True).when(v == 0, False)
        return v.try_cast(target)
    if isinstance(target, T.VariantType):
        return _strict_json(v if is_text else v.cast("string"))
    if isinstance(target, T.BinaryType):
        if not is_text:
            return v.try_cast(target)
        # ``unhex`` reads an odd digit count too, which the target's input does not.
        hexed = F.startswith(v, F.lit("\\x"))
        even = F.length(v) % 2 == 0
        return F.when(hexed & even, F.unhex(F.substr(v, F.lit(3)))).when(~hexed, F.encode(v, "UTF-8"))
    if isinstance(target, T.ArrayType):
        return array_literal(v, target) if is_text else v.try_cast(target)
    if isinstance(target, T.StructType):
        return composite_literal(v, target) if is_text else v.try_cast(target)
    if isinstance(target, (T.FloatType, T.DoubleType)):
        cast = v.try_cast(target)
        special = F.abs(cast) == F.lit(float("inf"))
        if is_text:
            # A number of the common size cannot overflow, so it needs one pattern and one cast.
            return (
                F.when(v.rlike(MODEST_NUMBER), cast)
                .when(v.rlike(NUMBER_PATTERN) & ~special, cast)
                .when(F.lower(tf.trim_space(v)).isin(*SPECIAL_FLOATS), cast)
            )
        return F.when(~special | (F.abs(v.cast("double")) == F.lit(float("inf"))), cast)
    if isinstance(target, T.IntegralType):
        if isinstance(dt, (T.DoubleType, T.DecimalType)):
            return F.when(v == F.floor(v), v.try_cast(target))
        return v.try_cast(target)
    if isinstance(target, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.when(v.rlike(DATE_PATTERN), v.try_cast(target)) if is_text else v.try_cast(target)
    if isinstance(target, T.StringType):
        text = v if is_text else v.cast("string")
        if plan.target in TIME_TARGETS:
            return F.when(tf.trim_space(text).rlike(TIME_PATTERN), _padded_time(tf.trim_space(text)))
        if plan.target == "uuid":
            return F.when(F.lower(text).rlike(UUID_PATTERN), F.lower(text))
        if plan.target in ("bit", "bit varying"):
            return F.when(text.rlike("^[01]*$"), text)
        if plan.length and plan.target in LENGTH_LIMITED:
            # Only trailing blanks may be cut off.
            fits = F.length(text) <= plan.length
            return F.when(fits, text).when(
                F.length(F.rtrim(text)) <= plan.length, F.substring(text, 1, plan.length)
            )
        return text
    return v.try_cast(target)


def _strict_json(v: Column) -> Column:
    """JSON text as a variant, NULL unless the whole text is one JSON value.

    The parser stops after the first value and ignores what follows. Text that is valid
    both as the only element of an array and as the only member of an object can have
    nothing after its first value: a comma there suits just one of the two.
    """
    as_element = F.try_parse_json(F.concat(F.lit("["), v, F.lit("]")))
    as_member = F.try_parse_json(F.concat(F.lit('{"v":'), v, F.lit("}")))
    return F.when(as_element.isNotNull(), F.try_variant_get(as_member, "$.v", "variant"))


def _padded_time(c: Column) -> Column:
    """``H:m[:s[.f]]`` -> ``HH:mm:ss[.f]``."""
    padded = F.regexp_replace(c, r"(?<![0-9.])([0-9])(?![0-9])", "0$1")
    return F.when(padded.rlike(r"^[0-9]{2}:[0-9]{2}$"), F.concat(padded, F.lit(":00"))).otherwise(padded)


def _reason(plan: CastPlan, prepared: Column, cast: Column) -> Column:
    """Why the row is bad in this column, or NULL."""
    wrong = prepared.isNotNull() & cast.isNull()
    type_text = plan.field.metadata["target_type"]
    if plan.length and plan.target in LENGTH_LIMITED:
        text = f"value longer than {plan.length} characters"
    elif isinstance(plan.field.dataType, T.VariantType):
        text = "invalid JSON"
    else:
        text = f"not a valid {type_text}"
    reason = F.when(wrong, F.lit(text))
    if plan.length and plan.target in ("bit", "bit varying"):
        reason = reason.when(F.length(cast) > plan.length, F.lit(f"value longer than {plan.length} bits"))
    if plan.column.labels:
        reason = reason.when(~cast.isin(*plan.column.labels), F.lit("not a label of the enum"))
    if not plan.column.nullable:
        reason = reason.when(cast.isNull(), F.lit("null value in a not-null column"))
    return reason


def _shown(raw: Column, dt: T.DataType) -> Column:
    return tf.byte_vector_to_bytea(raw, dt) if isinstance(dt, T.BinaryType) else raw.cast("string")


# --- whole tables --------------------------------------------------------------------


def cast_table(
    df: DataFrame,
    columns,
    dialect: str,
    user_rules=(),
    on_error: str = "reject",
    keep: tuple[str, ...] = (),
    where: Column | str | None = None,
    refuse_unlisted: bool = False,
) -> DataFrame:
    """Cast every column of ``columns`` to its target type.

    on_error 'reject' adds ``_errors`` (NULL for a good row), 'null' leaves NULL for a
    bad value, 'fail' stops the job at the first bad row. ``keep`` names further input
    columns to pass through. ``where`` selects source rows before anything is cast: a filter
    above the casts cannot reach the scan, this one prunes partitions and files there.
    """
    if on_error not in ("reject", "null", "fail"):
        raise ValueError(f"on_error must be reject, null or fail, not {on_error!r}")
    if where is not None:
        df = df.filter(where)
    plans = plan_casts(columns, dialect, user_rules, refuse_unlisted)
    source = {f.name: f.dataType for f in df.schema.fields}
    missing = [p.column.name for p in plans if p.column.name not in source]
    if missing:
        raise ValueError(f"columns not in the source: {missing}")

    # Projections one after the other: values, casts, reasons. Each refers to the columns of
    # the one before, so nothing is computed twice.
    kept = [F.col(quote(k)) for k in keep]
    values = []
    for i, plan in enumerate(plans):
        raw = F.col(quote(plan.column.name))
        values += [_prepared(plan, raw, source[plan.column.name], dialect).alias(f"_v{i}"), raw.alias(f"_r{i}")]
    prepared = df.select(*values, *kept)
    # The analysed schema knows the type that a transform gives, a user's own included.
    types = prepared.schema
    cast_df = prepared.select(
        "*", *[_to_target(p, F.col(f"_v{i}"), types[f"_v{i}"].dataType).alias(f"_c{i}") for i, p in enumerate(plans)]
    )
    targets = [
        F.col(f"_c{i}").alias(plan.column.name, metadata=plan.field.metadata) for i, plan in enumerate(plans)
    ]
    if on_error == "null":
        return cast_df.select(*targets, *kept)

    reasons = cast_df.select(
        "*", *[_reason(p, F.col(f"_v{i}"), F.col(f"_c{i}")).alias(f"_e{i}") for i, p in enumerate(plans)]
    )
    any_error = F.coalesce(*[F.col(f"_e{i}") for i in range(len(plans))]).isNotNull()
    # Concatenated one-element arrays stay in generated code, where filtering an array would not.
    none = F.array().cast(ERROR_TYPE)
    all_errors = F.concat(
        *[
            F.when(
                F.col(f"_e{i}").isNotNull(),
                F.array(
                    F.struct(
                        F.lit(plan.column.name).alias("column"),
                        _shown(F.col(f"_r{i}"), types[f"_r{i}"].dataType).alias("value"),
                        F.col(f"_e{i}").alias("reason"),
                    )
                ).cast(ERROR_TYPE),
            ).otherwise(none)
            for i, plan in enumerate(plans)
        ]
    )
    # Good rows carry NULL and never build the array. The partition number, always zero or
    # more, keeps the optimizer from moving a filter on the errors below the projections,
    # where it would compute every cast a second time.
    computed_here = F.spark_partition_id() >= 0
    checked = reasons.select(*targets, *kept, F.when(any_error & computed_here, all_errors).alias(ERRORS))
    if on_error == "fail":
        ok = F.when(F.col(ERRORS).isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("bad row: "), F.to_json(F.col(ERRORS)))).cast("boolean")
        )
        return checked.filter(ok).drop(ERRORS)
    return checked


def type_parts(columns_df: DataFrame) -> DataFrame:
    """A catalog of columns with the ``_base`` type, its own name as ``_fallback`` and the ``_mod`` of ``column_type``."""
    full = F.col("column_type")
    base = F.regexp_replace(tf.trim_space(full), r"(?s)(?<=.) (un)?signed.*", "")
    base = F.lower(tf.trim_space(F.regexp_replace(base, r"(?s)(?<=.)\(.*", "")))
    fallback = F.regexp_replace(tf.trim_space(full), r"\s*\(.*?\)", "")
    fallback = F.lower(tf.trim_space(F.regexp_replace(fallback, r"(?s)(?<=.) (un)?signed.*", "")))
    mod = F.regexp_extract(full, r"(?s)\((.*)\)", 1)
    return columns_df.select("*", base.alias("_base"), fallback.alias("_fallback"), mod.alias("_mod"))


def filled_target() -> Column:
    """The ``_target`` of a rule with the typemod filled in, or the type's own name without one."""
    used_mod = F.when(F.col("drop_typemod"), F.lit("")).otherwise(F.col("_mod"))
    filled = F.when(
        used_mod == "", F.replace(F.replace(F.col("_target"), F.lit("($mod)"), F.lit("")), F.lit("$mod"), F.lit(""))
    ).otherwise(F.replace(F.col("_target"), F.lit("$mod"), used_mod))
    return F.coalesce(filled, F.col("_fallback"))


def resolve_casts(columns_df: DataFrame, rules) -> DataFrame:
    """Resolve a whole catalog of columns: adds target_type, drop_typemod, transform.

    ``columns_df`` has ``column_type`` (full type text) and ``extra``. The rule list is a
    driver-side object, so the first match becomes one CASE expression over it: no
    join, no shuffle, whatever the number of catalog rows. ``rule_table`` takes rules that are a table.
    """
    full = F.col("column_type")
    extra = F.coalesce(F.col("extra"), F.lit(""))

    def condition(rule) -> Column:
        tests = [F.col("_base") == rule.source_type.lower()] if rule.source_type else []
        if rule.type_mod:
            tests.append(F.contains(full, F.lit(rule.type_mod)))
        for want, text, word in (
            (rule.unsigned, full, "unsigned"),
            (rule.auto_increment, extra, "auto_increment"),
            (rule.on_update, extra, "on update CURRENT_TIMESTAMP"),
        ):
            if want is not None:
                has = F.contains(text, F.lit(word))
                tests.append(has if want else ~has)
        out = F.lit(True)
        for test in tests:
            out = out & test
        return out

    number = F.lit(None).cast("int")
    chain = None
    for i, rule in enumerate(rules):
        chain = F.when(condition(rule), i) if chain is None else chain.when(condition(rule), i)
    if chain is not None:
        number = chain

    def pick(values, type_name: str) -> Column:
        # The rule number indexes a constant array; no match gives NULL.
        return F.get(F.array(*[F.lit(v).cast(type_name) for v in values]), F.col("_rule"))

    matched = type_parts(columns_df).select("*", number.alias("_rule"))
    picked = matched.select(
        "*",
        pick([r.target for r in rules], "string").alias("_target"),
        F.coalesce(pick([r.drop_typemod for r in rules], "boolean"), F.lit(False)).alias("drop_typemod"),
        pick([r.transform for r in rules], "string").alias("transform"),
    )
    return picked.select(
        *[F.col(quote(c)) for c in columns_df.columns],
        filled_target().alias("target_type"),
        "drop_typemod",
        "transform",
    )
