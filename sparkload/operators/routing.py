"""Routing rows to partitions whose bounds are a table: ranges over several columns, and lists of values.

Range bounds and keys are written as texts that sort as the columns do, so one comparison settles several columns. The
sorted bounds become a constant array that each row searches by halving: a projection, without a join or a
shuffle. More than ``CONSTANT_BOUNDS`` of them are searched in two steps, by every ``GROUP``-th bound first
and then, after an equality join on the group found, among those of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import quote
from .partitioning import PARTITION
from .skew import stored

CONSTANT_BOUNDS, GROUP = 50_000, 256
BROADCAST_VALUES = 1_000_000
BOUND = "array<struct<kind:int,value:string>>"  # kind: -1 below all values, 0 a value, 1 above all values
_SEPARATOR = "\x1f"

# PostgreSQL writes bounds like FOR VALUES FROM (2020, 'a') TO (2021, MINVALUE), and FOR VALUES IN ('a', NULL).
_ITEM = r"'(?:[^']|'')*'|[^\s,()']+"
_TUPLE = rf"\(\s*(?:{_ITEM})(?:\s*,\s*(?:{_ITEM}))*\s*\)"


def _items(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({_ITEM})"), F.lit(1))


def _unquoted(item: Column) -> Column:
    inside = F.substring(item, F.lit(2), F.length(item) - 2)
    return F.when(F.startswith(item, F.lit("'")), F.replace(inside, F.lit("''"), F.lit("'"))).otherwise(item)


def bounds_from_text(parts: DataFrame, name: str = "name", text: str = "bound") -> DataFrame:
    """``name, low, high`` of range partitions whose bounds are written as PostgreSQL does; others are left out."""

    def side(word: str) -> Column:
        items = _items(F.regexp_extract(F.col(quote(text)), rf"(?i)\b{word}\s*({_TUPLE})", 1))

        def bound(item: Column) -> Column:
            kind = F.when(F.upper(item) == "MINVALUE", -1).when(F.upper(item) == "MAXVALUE", 1).otherwise(0)
            return F.struct(kind.alias("kind"), F.when(kind == 0, _unquoted(item)).alias("value"))

        return F.transform(items, bound).cast(BOUND)

    ranges = parts.filter(F.col(quote(text)).rlike(rf"(?i)\bFROM\s*{_TUPLE}\s*TO\s*{_TUPLE}"))
    return ranges.select(F.col(quote(name)).alias("name"), side("FROM").alias("low"), side("TO").alias("high"))


def values_from_text(parts: DataFrame, name: str = "name", text: str = "bound") -> DataFrame:
    """``name, value`` of list partitions written as PostgreSQL does; a null value takes null keys."""
    lists = parts.filter(F.col(quote(text)).rlike(rf"(?i)\bIN\s*{_TUPLE}"))
    items = _items(F.regexp_extract(F.col(quote(text)), rf"(?i)\bIN\s*({_TUPLE})", 1))
    found = lists.select(F.col(quote(name)).alias("name"), F.explode(items).alias("item"))
    return found.select("name", F.when(F.upper("item") != "NULL", _unquoted(F.col("item"))).alias("value"))


def default_from_text(parts: DataFrame, name: str = "name", text: str = "bound") -> str | None:
    """Name of the partition that takes the rest; a table has one at most."""
    row = parts.filter(F.upper(F.trim(F.col(quote(text)))) == "DEFAULT").select(quote(name)).first()
    return row[0] if row else None


def sortable(value: Column, dt: T.DataType) -> Column:
    """Text that sorts, byte by byte, as the values of a type do."""
    if isinstance(dt, T.StringType):
        return F.hex(F.encode(value, "UTF-8"))
    if isinstance(dt, T.DecimalType):
        # Above zero by an offset, and of one length.
        shifted = value.cast("decimal(38,%d)" % dt.scale) + F.lit("1" + "0" * (37 - dt.scale)).cast("decimal(38,0)")
        return F.lpad(F.replace(shifted.cast(f"decimal(38,{dt.scale})").cast("string"), F.lit("."), F.lit("")), 39, "0")
    if isinstance(dt, T.DateType):
        number = F.unix_date(value).cast("bigint")
    elif isinstance(dt, T.TimestampType):
        number = F.unix_micros(value)
    elif isinstance(dt, (T.IntegralType, T.BooleanType)):
        number = value.cast("bigint")
    else:
        raise ValueError(f"no range partitions over {dt.simpleString()}")
    return F.lpad(F.hex(number.bitwiseXOR(F.lit(-(2**63)))), 16, "0")


def _key_text(df: DataFrame, keys) -> tuple[Column, list[T.DataType]]:
    types = [f.dataType for f in df.select(*[F.expr(k).alias(f"k{i}") for i, k in enumerate(keys)]).schema.fields]
    parts = [F.concat(F.lit("1"), sortable(F.expr(k), dt)) for k, dt in zip(keys, types)]
    return F.concat(*[x for p in parts for x in (F.lit("!"), p)][1:]), types  # null if any part is


def _bound_text(bound: str, types: list[T.DataType]) -> Column:
    """Bounds as texts, null where one does not fit its column; ``!`` sorts before whatever a longer text goes on with."""
    out = []
    for i, dt in enumerate(types):
        item = F.get(F.col(bound), F.lit(i))
        text = F.concat(F.lit("1"), sortable(item["value"].try_cast(dt), dt))
        out += [F.lit("!"), F.when(item["kind"] < 0, "0").when(item["kind"] > 0, "2").otherwise(text)]
    return F.when((F.size(bound) == len(types)), F.concat(*out[1:]))


def sorted_bounds(bounds: DataFrame, types: list[T.DataType]) -> DataFrame:
    """``place, name, low, high`` of checked bounds in ascending order, stored.

    Bounds are metadata, far fewer than rows; their order is the only thing made in one task.
    """
    texts = bounds.select("name", _bound_text("low", types).alias("low"), _bound_text("high", types).alias("high"))
    order = Window.orderBy("low", "high")
    placed = texts.select("*", (F.row_number().over(order) - 1).alias("place"), F.lag("high").over(order).alias("before"), F.lag("name").over(order).alias("left"))
    found = stored(placed, "bounds")
    wrong = found.filter("low IS NULL OR high IS NULL OR low >= high OR before > low OR contains(name, '\x1f')").orderBy("place").first()
    if wrong:
        if wrong.low is None or wrong.high is None:
            raise ValueError(f"bounds of {wrong['name']!r} do not fit the key columns")
        if wrong.low >= wrong.high:
            raise ValueError(f"range {wrong['name']!r} is empty")
        raise ValueError(f"ranges {wrong['left']!r} and {wrong['name']!r} overlap")
    return found.select("place", "name", "low", "high")


def _constant(texts: list[str]) -> Column:
    """A constant array from one literal: splitting it is folded when the plan is made."""
    return F.split(F.lit(_SEPARATOR.join(texts)), _SEPARATOR)


def _last_at_most(key: Column, lows: list[str]) -> Column:
    """Place of the last of the sorted texts that is not above the key, -1 if all are."""
    steps = max(1, len(lows).bit_length())
    array = _constant(lows)

    def step(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"] + 1) / 2).cast("int")
        fits = (middle < len(lows)) & (F.get(array, middle) <= state["key"])
        narrowed = lambda name, inside: F.when(state["low"] >= state["high"], state[name]).otherwise(inside)
        return F.struct(
            narrowed("low", F.when(fits, middle).otherwise(state["low"])).cast("int").alias("low"),
            narrowed("high", F.when(fits, state["high"]).otherwise(middle - 1)).cast("int").alias("high"),
            state["key"].alias("key"),
        )

    begin = F.struct(F.lit(-1).alias("low"), F.lit(len(lows) - 1).alias("high"), key.alias("key"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, step, lambda state: state["low"])


def route_by_bounds(df: DataFrame, keys, bounds: DataFrame, default: str | None = None) -> DataFrame:
    """Add ``partition_name`` by a table of ranges ``name, low, high`` over one or more key columns or expressions.

    ``low`` and ``high`` are arrays with a bound for each key, see ``BOUND``; rows compare column by column, the low bound
    inclusive and the high one exclusive. A row with a null among its keys, or between the ranges, goes to
    ``default``. Ranges that overlap, are empty or do not fit the keys' types are a ValueError.
    """
    text, types = _key_text(df, keys)
    ordered = sorted_bounds(bounds, types)
    n = ordered.count()
    keyed = df.withColumn("_key", text)
    rest = F.lit(default).cast("string")
    if n == 0:
        return df.withColumn(PARTITION, rest)
    if n <= CONSTANT_BOUNDS:
        rows = ordered.orderBy("place").collect()
        placed = keyed.withColumn("_place", F.when(F.col("_key").isNotNull(), _last_at_most(F.col("_key"), [r.low for r in rows])))
        inside = F.col("_key") < F.get(_constant([r.high for r in rows]), F.col("_place"))
        name = F.when((F.col("_place") >= 0) & inside, F.get(_constant([r["name"] for r in rows]), F.col("_place")))
        return placed.withColumn(PARTITION, F.coalesce(name, rest)).drop("_key", "_place")
    heads = [r.low for r in ordered.filter(F.col("place") % GROUP == 0).orderBy("place").collect()]
    groups = ordered.groupBy(F.floor(F.col("place") / GROUP).cast("int").alias("_group")).agg(F.collect_list(F.struct("low", "high", "name")).alias("_ranges"))
    placed = keyed.withColumn("_place", F.when(F.col("_key").isNotNull(), _last_at_most(F.col("_key"), heads)))
    met = placed.join(groups, F.col("_place") == F.col("_group"), "left")
    hit = F.filter("_ranges", lambda r: (r["low"] <= F.col("_key")) & (F.col("_key") < r["high"]))
    return met.withColumn(PARTITION, F.coalesce(F.get(hit, F.lit(0))["name"], rest)).drop("_key", "_place", "_group", "_ranges")


def route_by_values(df: DataFrame, key: str, values: DataFrame, default: str | None = None) -> DataFrame:
    """Add ``partition_name`` by a table of list values ``name, value``: an equality join, whatever the number of values.

    A null value takes null keys. Up to ``BROADCAST_VALUES`` values are broadcast, so that rows are not shuffled.
    """
    dt = df.select(F.expr(key).alias("k")).schema["k"].dataType
    typed = stored(values.select(F.col("name").alias("_name"), F.col("value").try_cast(dt).alias("_value"), F.col("value").alias("_text")), "values")
    lost = typed.filter("_value IS NULL AND _text IS NOT NULL").first()
    if lost:
        raise ValueError(f"value {lost['_text']!r} of {lost['_name']!r} does not fit the key")
    twice = typed.groupBy("_value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if twice:
        raise ValueError(f"value listed twice: {twice['_value']!r}")
    small = typed.count() <= BROADCAST_VALUES
    met = df.join((F.broadcast(typed) if small else typed).drop("_text"), F.expr(key).eqNullSafe(F.col("_value")), "left")
    return met.withColumn(PARTITION, F.coalesce("_name", F.lit(default).cast("string"))).drop("_name", "_value")
