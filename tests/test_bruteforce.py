"""Operators against plain Python on random small tables, a third of whose rows share one key."""

import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkload import (
    ForeignKeySpec, PartitionSpec, child_parent_join, collect_ordered, compare_tables, fk_orphan_rows, fk_orphans,
    key_violation_rows, key_violations, pk_ranges, read_copy_text, route_partition, row_difference, shard_by_pk,
    write_copy_text,
)
from sparkload.functions.transforms import money_to_numeric


def bag(rows):
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)

    def key():
        return 5 if rng.random() < 0.33 else rng.choice([None, *range(60)])

    child = [(i, key(), rng.choice([None, 1, 2])) for i in range(900)]
    child += child[:50]
    parent = [(k, n, f"p{k}-{n}") for k in range(0, 60, 2) for n in (1, 2) if rng.random() < 0.8]
    return child, parent


@pytest.fixture(scope="module", params=[1, 8])
def frames(spark, data, request):
    child = spark.createDataFrame(data[0], "id int, a int, b int").repartition(request.param)
    parent = spark.createDataFrame(data[1], "x int, y int, name string").repartition(request.param)
    return child, parent


def test_keys(data, frames):
    counts = Counter((a, b) for _, a, b in data[0])
    want = {(a, b, n, "null key" if None in (a, b) else "duplicate key") for (a, b), n in counts.items() if None in (a, b) or n > 1}
    assert {tuple(r) for r in key_violations(frames[0], ["a", "b"], primary=True).collect()} == want
    clash = [r for r in data[0] if None not in r[1:] and counts[r[1:]] > 1]
    assert bag(key_violation_rows(frames[0], ["a", "b"]).collect()) == bag(clash)


@pytest.mark.parametrize("match", ["simple", "full"])
def test_references(data, frames, match):
    parents = {(x, y) for x, y, _ in data[1]}
    fk = ForeignKeySpec(("a", "b"), "p", ("x", "y"), match=match)
    bad = [
        r for r in data[0]
        if (None not in r[1:] and r[1:] not in parents) or (match == "full" and r[1:].count(None) == 1)
    ]
    counts = Counter(r[1:] for r in bad)
    assert {tuple(r)[:3] for r in fk_orphans(*frames, fk).collect()} == {(*k, n) for k, n in counts.items()}
    assert bag(fk_orphan_rows(*frames, fk).collect()) == bag(bad)


@pytest.mark.parametrize("hot_rows", [None, 50, 10**6])
def test_join(data, frames, hot_rows):
    want = [(*c, p[0], p[1], p[2]) for c in data[0] for p in data[1] if c[1] == p[0] and c[2] == p[1]]
    fk = ForeignKeySpec(("a", "b"), "p", ("x", "y"))
    assert bag(child_parent_join(*frames, fk, hot_rows=hot_rows).collect()) == bag(want)


def test_comparison(spark, data, frames):
    rng = random.Random(8)
    src = [(a, b) for _, a, b in data[0]]
    tgt = [r for r in src if rng.random() < 0.9] + [(5, 9), (99, None), (99, None)]
    target = spark.createDataFrame(tgt, "a int, b int")
    source = frames[0].select("a", "b")
    missing, extra = Counter(src) - Counter(tgt), Counter(tgt) - Counter(src)
    got = row_difference(source, target).collect()
    assert {(r.a, r.b): r.missing for r in got if r.missing} == missing
    assert {(r.a, r.b): r.extra for r in got if r.extra} == extra
    for fp in (False, True):
        row = compare_tables(source, target, by_fingerprint=fp).first()
        assert (row.src_rows, row.tgt_rows, row.missing, row.extra) == (
            len(src), len(tgt), sum(missing.values()), sum(extra.values())
        )
    by_key = compare_tables(source, target, ["a"]).first()
    groups = [defaultdict(Counter), defaultdict(Counter)]
    for side, rows in zip(groups, (src, tgt)):
        for a, b in rows:
            side[a][b] += 1
    assert by_key.missing == len(groups[0].keys() - groups[1].keys())
    assert by_key.extra == len(groups[1].keys() - groups[0].keys())
    assert by_key.changed == sum(groups[0][k] != groups[1][k] for k in groups[0].keys() & groups[1].keys())


def test_ordered_lists(spark, frames):
    rng = random.Random(9)
    rows = [(5 if i % 3 == 0 else i % 17, i, f"v{i}") for i in range(600)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, pos int, v string").repartition(4)
    want = defaultdict(list)
    for k, pos, v in sorted(rows, key=lambda r: r[1]):
        want[k, pos // 64].append(v)
    got = {(r.k, r.block): r["values"] for r in collect_ordered(df, ["k"], "v", "pos", block=64, first=0).collect()}
    assert got == dict(want) and max(map(len, got.values())) <= 64


def test_routing_and_shards(spark):
    rng = random.Random(10)
    cuts = sorted(rng.sample(range(-500, 500), 41))
    parts = [(f"p{i}", lo, hi) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if i % 7 != 3]
    keys = [None, *range(-510, 510)]
    df = spark.createDataFrame([(k,) for k in keys], "k int")

    def home(k):
        return next((n for n, lo, hi in parts if k is not None and lo <= k < hi), None)

    rng.shuffle(parts)
    spec = PartitionSpec("range", "k", tuple(parts))
    assert {r.k: r.partition_name for r in route_partition(df, spec).collect()} == {k: home(k) for k in keys}
    ranges = pk_ranges(-510, 509, 7)
    sharded = shard_by_pk(df.filter("k is not null"), "k", 7).collect()
    assert all(ranges[r.shard_id][0] <= r.k < ranges[r.shard_id][1] for r in sharded)


def test_copy_text_of_random_strings(spark, tmp_path):
    rng = random.Random(11)
    alphabet = ["\\", "\t", "\n", "\r", "\b", "\f", "\v", "n", "t", "N", "x", ".", '"', ",", " ", "é", "漢", " ", "\x85", "\x01"]
    rows = [(i, None if rng.random() < 0.1 else "".join(rng.choices(alphabet, k=rng.randrange(0, 12)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, v string").repartition(3)
    back = read_copy_text(spark, write_copy_text(df, str(tmp_path / "x")), ["id", "v"])
    assert {int(r.id): r.v for r in back.collect()} == dict(rows)


def test_money_in_every_notation(spark):
    rng = random.Random(12)
    rows = []
    for i in range(2000):
        value = Decimal(rng.randrange(-10**11, 10**11)) / 100
        plain = f"{abs(value):,.2f}"
        european = plain.translate(str.maketrans(",.", ".,"))
        text = rng.choice([f"${plain}", f"EUR {european}", f"{european} €", plain, f"{abs(value):.2f}"])
        if value < 0:
            text = rng.choice([f"({text})", f"-{text}"])
        rows.append((i, text, value))
    df = spark.createDataFrame(rows, "i int, text string, value decimal(20,2)")
    wrong = df.withColumn("got", money_to_numeric(F.col("text")).try_cast("decimal(20,2)")).filter("NOT got <=> value")
    assert wrong.collect() == []
