"""Cast rules held as a table: one ordered rule list for each catalog, resolved by hash joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quote
from ..model import CastRule
from .casting import filled_target, type_parts

RULES_SCHEMA = (
    "catalog string, priority int, source_type string, type_mod string, unsigned boolean, auto_increment boolean, "
    "on_update boolean, target string, drop_typemod boolean, transform string"
)
_TESTS = ("type_mod", "unsigned", "auto_increment", "on_update", "target", "drop_typemod", "transform")


def rules_table(spark: SparkSession, catalogs: dict[str, tuple[CastRule, ...]]) -> DataFrame:
    """Rule lists by catalog as a table; the place in the list is the priority."""
    rows = [
        (name, i, r.source_type, r.type_mod, r.unsigned, r.auto_increment, r.on_update, r.target, r.drop_typemod, r.transform)
        for name, rules in catalogs.items()
        for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(rows, RULES_SCHEMA)


def _matches(rule: Column) -> Column:
    full, extra = F.col("column_type"), F.coalesce(F.col("extra"), F.lit(""))
    out = F.contains(full, F.coalesce(rule["type_mod"], F.lit("")))
    for name, text, word in (
        ("unsigned", full, "unsigned"),
        ("auto_increment", extra, "auto_increment"),
        ("on_update", extra, "on update CURRENT_TIMESTAMP"),
    ):
        out = out & (rule[name].isNull() | (rule[name] == F.contains(text, F.lit(word))))
    return out


def resolve_casts_table(columns_df: DataFrame, rules_df: DataFrame) -> DataFrame:
    """Resolve columns of many catalogs by the rules of each: adds target_type, drop_typemod, transform.

    ``columns_df`` has ``catalog``, ``column_type`` (full type text) and ``extra``; ``rules_df`` is as in ``RULES_SCHEMA``. The
    matching rule of least priority decides. Rules of a type meet columns by an equality join on catalog and base type,
    and those for any type (no ``source_type``) by one on the catalog; both are gathered in lists first, so a column stays
    one row and nothing is grouped afterwards. A list holds one catalog's rules for one type. A column of a catalog
    without rules, or without a matching one, keeps its type's own name.
    """
    rule = F.struct("priority", *_TESTS)
    typed = rules_df.filter("coalesce(source_type, '') <> ''")
    typed = typed.groupBy(F.col("catalog").alias("_c"), F.lower("source_type").alias("_t")).agg(F.collect_list(rule).alias("_typed"))
    open_ = rules_df.filter("coalesce(source_type, '') = ''")
    open_ = open_.groupBy(F.col("catalog").alias("_w")).agg(F.collect_list(rule).alias("_any"))
    parts = type_parts(columns_df)
    met = parts.join(typed, (F.col("catalog") == F.col("_c")) & (F.col("_base") == F.col("_t")), "left")
    met = met.join(open_, F.col("catalog") == F.col("_w"), "left")
    none = F.array().cast(typed.schema["_typed"].dataType)
    candidates = F.concat(F.coalesce("_typed", none), F.coalesce("_any", none))
    chosen = met.withColumn("_rule", F.array_min(F.filter(candidates, _matches)))  # structs compare by priority first
    chosen = chosen.select(
        "*",
        F.col("_rule.target").alias("_target"),
        F.coalesce("_rule.drop_typemod", F.lit(False)).alias("drop_typemod"),
        F.col("_rule.transform").alias("transform"),
    )
    return chosen.select(*[F.col(quote(c)) for c in columns_df.columns], filled_target().alias("target_type"), "drop_typemod", "transform")
