"""Checks of keys, references, nulls, enum labels and sequences.

Files enforce nothing, so each check is a query that returns what is wrong. Checks
group by key before anything is joined: a key that holds a third of the table travels
as one partial count per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import quote
from ..model import ForeignKeySpec, KeySpec, TableSpec
from .skew import rows_with_keys, skew_join


def _cols(names) -> list[Column]:
    return [F.col(quote(n)) for n in names]


def _any_null(names) -> Column:
    out = F.lit(False)
    for n in names:
        out = out | F.col(quote(n)).isNull()
    return out


def _all_null(names) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(quote(n)).isNull()
    return out


# --- keys ----------------------------------------------------------------------------


def key_violations(df: DataFrame, cols, primary: bool = False, predicate: str | None = None) -> DataFrame:
    """Offending keys with their number of rows and the reason.

    A primary key must not be NULL in any column; for a unique key, NULLs never clash.
    ``predicate`` limits the check to some rows (filtered key). Row counts come from
    partial aggregation.
    """
    cols = list(cols)
    rows = df.filter(predicate) if predicate else df
    if not primary:
        rows = rows.filter(~_any_null(cols))
    counts = rows.groupBy(*_cols(cols)).agg(F.count(F.lit(1)).alias("n_rows"))
    reason = F.when(_any_null(cols), F.lit("null key")).when(F.col("n_rows") > 1, F.lit("duplicate key"))
    return counts.select(*_cols(cols), "n_rows", reason.alias("reason")).filter(F.col("reason").isNotNull())


def key_violation_rows(df: DataFrame, cols, primary: bool = False, predicate: str | None = None) -> DataFrame:
    """The offending rows themselves."""
    cols = list(cols)
    rows = df.filter(predicate) if predicate else df
    duplicates = key_violations(rows, cols).select(*_cols(cols))
    out = rows_with_keys(rows, duplicates, cols).select(*_cols(df.columns))
    return out.unionByName(rows.filter(_any_null(cols))) if primary else out


def check_key(df: DataFrame, key: KeySpec) -> DataFrame:
    return key_violations(df, key.columns, key.primary, key.predicate)


# --- references ----------------------------------------------------------------------


def fk_orphans(child: DataFrame, parent: DataFrame, fk: ForeignKeySpec) -> DataFrame:
    """Child keys without a parent: key columns, ``n_rows`` child rows, reason.

    match 'simple' does not check a key with any NULL part; 'full' allows only all or no
    parts NULL. Child and parent are reduced to distinct keys first, and the anti join
    reuses the partitioning of those two aggregations.
    """
    cols = list(fk.columns)
    keys = child.groupBy(*_cols(cols)).agg(F.count(F.lit(1)).alias("n_rows"))
    parents = (
        parent.select(*[F.col(quote(p)).alias(f"_p{i}") for i, p in enumerate(fk.parent_columns)])
        .filter(~_any_null([f"_p{i}" for i in range(len(cols))]))
        .distinct()
    )
    condition = F.lit(True)
    for i, c in enumerate(cols):
        condition = condition & (F.col(quote(c)) == F.col(f"_p{i}"))
    orphans = (
        keys.filter(~_any_null(cols))
        .join(parents, condition, "left_anti")
        .select(*_cols(cols), "n_rows", F.lit("no parent").alias("reason"))
    )
    if fk.match.lower() != "full" or len(cols) == 1:
        return orphans
    partial = keys.filter(_any_null(cols) & ~_all_null(cols))
    return orphans.unionByName(partial.select(*_cols(cols), "n_rows", F.lit("partly null key").alias("reason")))


def fk_orphan_rows(child: DataFrame, parent: DataFrame, fk: ForeignKeySpec) -> DataFrame:
    """The child rows without a parent."""
    cols = list(fk.columns)
    orphans = fk_orphans(child, parent, fk)
    out = rows_with_keys(child, orphans.filter(F.col("reason") == "no parent"), cols).select(*_cols(child.columns))
    if fk.match.lower() != "full":
        return out
    return out.unionByName(child.filter(_any_null(cols) & ~_all_null(cols)))


def child_parent_join(child: DataFrame, parent: DataFrame, fk: ForeignKeySpec, hot_rows: int | None = None) -> DataFrame:
    """Child rows with the columns of their parent.

    Parents of very many children are left to adaptive execution, or with ``hot_rows`` found first and joined apart.
    """
    cols = list(fk.columns)
    clash = (set(child.columns) & set(parent.columns)) - set(fk.parent_columns)
    if clash:
        raise ValueError(f"rename these parent columns first: {sorted(clash)}")
    # The parent key is renamed to the child's, then shown under its own name again.
    renamed = parent.select(
        *[F.col(quote(p)).alias(c) for p, c in zip(fk.parent_columns, cols)],
        *_cols([c for c in parent.columns if c not in fk.parent_columns]),
    )
    joined = skew_join(child, renamed, cols, min_rows=hot_rows)
    key_back = [
        F.col(quote(c)).alias(p) for p, c in zip(fk.parent_columns, cols) if p not in child.columns
    ]
    return joined.select(
        *_cols(child.columns), *key_back, *_cols([c for c in parent.columns if c not in fk.parent_columns])
    )


# --- values --------------------------------------------------------------------------


def null_violations(df: DataFrame, cols) -> DataFrame:
    """(column, n_nulls) for every column of ``cols`` that holds NULLs; one pass."""
    cols = list(cols)
    counted = df.agg(*[F.count_if(F.col(quote(c)).isNull()).alias(c) for c in cols])
    long = counted.unpivot([], _cols(cols), "column", "n_nulls")
    return long.filter(F.col("n_nulls") > 0)


def enum_violations(df: DataFrame, col: str, labels) -> DataFrame:
    """Values that are no label of the enum, with their number of rows; ``labels.unknown_labels`` takes long lists."""
    value = F.col(quote(col))
    return (
        df.filter(value.isNotNull() & ~value.isin(*labels))
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def sequence_state(df: DataFrame, cols) -> DataFrame:
    """(column, last_value, next_value) after a load; an empty table counts from 1."""
    cols = list(cols)
    top = df.agg(*[F.coalesce(F.max(quote(c)), F.lit(1)).cast("decimal(38,0)").alias(c) for c in cols])
    long = top.unpivot([], _cols(cols), "column", "v")
    return long.select(
        "column", F.col("v").cast("bigint").alias("last_value"), (F.col("v") + 1).cast("bigint").alias("next_value")
    )


SUMMARY = "check string, columns string, n_keys bigint, n_rows bigint"


def _key_text(columns) -> Column:
    """A key of any columns as one text, NULLs and all."""
    return F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})


def check_table(
    df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame] | None = None, keys: bool = True
) -> DataFrame:
    """All declared keys, references, not-null columns and enum labels: (check, columns, n_keys, n_rows).

    One row per check, zeros where all is well. A reference to a table that ``parents`` lacks cannot be
    checked: its row says so and has no counts.

    The table is read once: a row becomes one short row for each check that it concerns, and one aggregation by check
    and key, combined before its only shuffle, serves them all. References then meet the distinct keys of all
    parents in one anti join.
    """
    spark = df.sparkSession
    names: list[tuple[str, str, bool]] = []  # of each check: kind, columns, whether it can be made
    entries: list[Column] = []
    parent_keys: list[DataFrame] = []

    def entry(check: str, columns, key: Column, concerns: Column, null: Column, checked: bool = True) -> int:
        number = len(names)
        names.append((check, ",".join(columns), checked))
        entries.append(F.when(concerns, F.struct(F.lit(number).alias("check"), key.alias("key"), null.alias("null"))))
        return number

    for key in spec.keys if keys else ():
        cols = list(key.columns)
        concerns = F.coalesce(F.expr(key.predicate), F.lit(False)) if key.predicate else F.lit(True)
        if not key.primary:
            concerns = concerns & ~_any_null(cols)
        entry("primary key" if key.primary else "unique key", cols, _key_text(_cols(cols)), concerns, _any_null(cols))
    references: list[int] = []
    for fk in spec.foreign_keys:
        cols = list(fk.columns)
        if parents and fk.parent in parents:
            full = fk.match.lower() == "full" and len(cols) > 1
            concerns = ~_all_null(cols) if full else ~_any_null(cols)
            number = entry("foreign key", cols, _key_text(_cols(cols)), concerns, _any_null(cols))
            references.append(number)
            types = [df.schema[c].dataType for c in cols]
            parent = parents[fk.parent].select(*[F.col(quote(p)).try_cast(t).alias(f"p{i}") for i, (p, t) in enumerate(zip(fk.parent_columns, types))])
            parent = parent.filter(~_any_null(parent.columns))
            parent_keys.append(parent.select(F.lit(number).alias("of"), _key_text([F.col(c) for c in parent.columns]).alias("parent")).distinct())
        elif parents is not None:
            names.append((f"foreign key, {fk.parent} not loaded", ",".join(cols), False))
    required = [c.name for c in spec.columns if not c.nullable]
    if required:
        # One entry for each column that is NULL in the row.
        number = len(names)
        names.append(("not null", ",".join(required), True))
        for c in required:
            entries.append(F.when(F.col(quote(c)).isNull(), F.struct(F.lit(number).alias("check"), F.lit(c).alias("key"), F.lit(True).alias("null"))))
    for c in spec.columns:
        if c.labels and c.name in df.columns:
            value = F.col(quote(c.name)).cast("string")
            entry("enum", (c.name,), value, value.isNotNull() & ~value.isin(*c.labels), F.lit(True))
    if not names:
        return spark.createDataFrame([], SUMMARY)
    checks = spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "id int, check string, columns string, checked boolean")
    if not entries:
        return checks.select("check", "columns", F.lit(None).cast("bigint").alias("n_keys"), F.lit(None).cast("bigint").alias("n_rows"))
    each = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
    counted = each.groupBy("e.check", "e.key", "e.null").agg(F.count(F.lit(1)).alias("n_rows"))
    is_reference = F.col("check").isin(*references) if references else F.lit(False)
    # A key is wrong if it occurs twice or holds a NULL that it must not; the other checks list what is wrong alone.
    wrong = F.when(is_reference | F.col("null"), F.lit(True)).otherwise(F.col("n_rows") > 1)
    found = counted.filter(wrong)
    if parent_keys:
        known = reduce(DataFrame.unionByName, parent_keys)
        met = is_reference & ~F.col("null") & (F.col("check") == F.col("of")) & (F.col("key") == F.col("parent"))
        found = found.join(known, met, "left_anti")
    summed = found.groupBy(F.col("check").alias("of")).agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows"))
    zero = lambda c: F.when(F.col("checked"), F.coalesce(c, F.lit(0))).cast("bigint").alias(c)
    return checks.join(F.broadcast(summed), F.col("id") == F.col("of"), "left").select("check", "columns", zero("n_keys"), zero("n_rows"))
