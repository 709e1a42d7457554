import random
from collections import Counter

import numpy as np
import pytest

from sparkload.llm import neardup
from sparkload.llm.components import connected_components
from sparkload.llm.neardup import dart_minhash, elements_of, near_duplicate_classes, one_of_each_class, words_of


def weighted_jaccard(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def counts_of(text):
    w = words_of(text)
    if not w:
        return None
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_force(rows, threshold=0.8):
    """Class of every id by all pairs and repeated relabelling."""
    texts = {}
    for i, t in rows:
        if i is not None:
            texts[i] = min(texts.get(i, t or ""), t or "")
    sets = {i: counts_of(t) for i, t in texts.items()}
    label = {i: i for i in texts}
    ids = sorted(texts)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if (texts[a] == texts[b] or (sets[a] and sets[b] and weighted_jaccard(sets[a], sets[b]) >= threshold))
    ]
    for _ in ids:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for length in (30, 60, 120, 300, 7, 4):
        base = [rng.choice(vocabulary) for _ in range(length)]
        for edits in (0, 0, 1, 1, 2, 3, 5, 9):
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(length)] = rng.choice(vocabulary)
            rows.append((n, " ".join(words)))
            n += 1
    shared = " ".join(rng.choice(vocabulary) for _ in range(40))  # documents that share most of a passage but are apart
    rows += [(n + k, shared + " " + " ".join(rng.choice(vocabulary) for _ in range(25))) for k in range(30)]
    rows += [(200, "again again again " * 40), (201, "again again again " * 41), (202, "again again again " * 4)]
    rows += [(300, None), (301, ""), (302, "!!!"), (303, "???"), (304, "!!!"), (305, "One."), (306, "one"), (None, "one"), (None, None)]
    rows += [(0, rows[0][1]), (5, "another text under a used id that is quite short")]
    return rows


@pytest.mark.parametrize("seed", [3, 4])
def test_classes_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, bands string").repartition(3)
    got = near_duplicate_classes(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_force(rows) and len(got) == len({i for i, _ in rows} - {None})


def test_links_outside_the_star_are_found(spark, monkeypatch):
    """With one band for everything, every pair that the bucket's smallest text does not cover is still compared."""
    rows = corpus(5)

    def one_bucket(texts, bands, rows_):
        made = original(texts, bands, rows_)
        return made.selectExpr("id", "print", "n", "if(n > 0, array(7L), array()) AS bands", "sketch")

    original = neardup.signatures
    monkeypatch.setattr(neardup, "signatures", one_bucket)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_duplicate_classes(docs).collect()}
    assert got == brute_force(rows)


def test_one_of_each_class_keeps_columns_and_rows_without_id(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _wanted int")
    kept = one_of_each_class(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert Counter(i for i in ids if i is not None) == Counter(set(brute_force(rows).values()))
    assert ids.count(None) == 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicate_classes(docs).columns == ["doc_id", "class_id"] and near_duplicate_classes(docs).count() == 0
    assert one_of_each_class(docs).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(2)
    n = 300
    elements = rng.integers(0, 2**63, n, dtype=np.uint64)
    a, b = rng.random(n) * 4, rng.random(n) * 4
    b[:200] = a[:200]
    a[250:] = 0
    b[:20] = 0
    keep_a, keep_b = a > 0, b > 0
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    k = 4096
    s = dart_minhash(
        np.concatenate([elements[keep_a], elements[keep_b]]),
        np.concatenate([a[keep_a], b[keep_b]]),
        np.concatenate([np.zeros(keep_a.sum(), int), np.ones(keep_b.sum(), int)]),
        2,
        k,
    )
    assert abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / k) ** 0.5


def test_signatures_do_not_depend_on_company():
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 3, 50, 6000)]
    together = dart_minhash(np.concatenate(sets), np.ones(sum(map(len, sets))), np.repeat(np.arange(4), [len(s) for s in sets]), 4, 160)
    for i, s in enumerate(sets):
        alone = dart_minhash(s, np.ones(len(s)), np.zeros(len(s), int), 1, 160)
        assert (alone[0] == together[i]).all() and (alone != 0).all()


def test_elements_count_repeats():
    a, b = words_of("a b c d e " * 9), words_of("a b c d e " * 12)
    x, y = set(elements_of(a).tolist()), set(elements_of(b).tolist())
    ca, cb = counts_of(" ".join(a)), counts_of(" ".join(b))
    assert len(x & y) / len(x | y) == pytest.approx(weighted_jaccard(ca, cb))


@pytest.mark.parametrize("n", [0, 1, 40])
def test_components(spark, n):
    rng = random.Random(n)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(n)] + [(i, i + 1) for i in range(100, 130)] * (n > 1) + [(7, 7)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == label and len(got) == len(label)


def family(n=300, length=130, seed=11):
    """Versions of one text with 0 to 8 words replaced: linked to each other where few are, nearly so where more are."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(900)}" for _ in range(length)]
    rows = []
    for k in range(n):
        words = list(base)
        for at in rng.sample(range(length), k % 9):
            words[at] = f"v{rng.randrange(60)}" if k % 2 else f"own{k}x{at}"
        rows.append((k, " ".join(words)))
    return rows


def test_a_group_just_below_the_threshold_makes_few_pairs(spark, monkeypatch):
    rows = family()
    compared = []
    original = neardup.similar_pairs

    def counted(pairs, *rest):
        pairs = neardup.stored(pairs, "counted")
        compared.append(pairs.count())
        return original(pairs, *rest)

    monkeypatch.setattr(neardup, "similar_pairs", counted)
    got = {r.doc_id: r.class_id for r in near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows)
    assert len(compared) == 3 and compared[2] < 2 * len(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_bounds_of_rare_pairs_drop_no_similar_pair(spark, seed):
    """With every text a component of its own, all similar pairs must be among the pairs made."""
    rng = random.Random(seed)
    rows = [(i, t) for i, t in corpus(seed) if i is not None and t and counts_of(t)] + [(1000 + i, t) for i, t in family(150, 80, seed)]
    rows += [(2000 + k, " ".join(rng.choice("abc") for _ in range(30 + k % 7))) for k in range(40)]  # sets with many repeats
    texts = list({t: i for i, t in rows}.items())
    sets = [(i, i, elements_of(words_of(t)).tolist()) for t, i in texts]
    frame = spark.createDataFrame(sets, "id long, component long, elements array<long>")
    facts = frame.selectExpr("id", "struct(cast(size(elements) as bigint) AS n, array(0L) AS sketch) AS f")
    rare = neardup.rarest_elements(frame, facts, 0.8).withColumn("component", neardup.F.col("id")).withColumn("outside", neardup.F.lit(True))
    pairs = [(r.a, r.b) for r in neardup.rare_pairs(rare, 0.8, 64).collect()]
    want = {
        (min(i, j), max(i, j))
        for k, (i, _, a) in enumerate(sets)
        for j, _, b in sets[k + 1 :]
        if len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b))
    }
    assert len(want) > 30 and want <= set(pairs) and len(pairs) == len(set(pairs)) < len(sets) * (len(sets) - 1) / 4


def test_workers_hold_nothing_after_signatures_and_sets(spark):
    """The stages after them need the memory; a batch is worked on in slices."""
    import pyarrow as pa

    def look(batches):
        from sparkload.llm import common

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._HELD)] * batch.num_rows, pa.int64())], ["held"])

    texts = spark.createDataFrame([(k, f"one two three four five six {k}") for k in range(400)], "id long, text string").repartition(4).cache()
    assert len(neardup.signatures(texts).collect()) == 400
    assert {r.held for r in texts.mapInArrow(look, "held long").collect()} == {0}
    assert neardup.element_sets(texts, texts.select("id")).count() == 400
    assert {r.held for r in texts.mapInArrow(look, "held long").collect()} == {0}

    def size(batch):
        return pa.RecordBatch.from_arrays([pa.array([batch.num_rows] * batch.num_rows, pa.int64())], ["n"])

    sizes = [r.n for r in neardup.map_texts(texts, size, "n long", 30).collect()]
    assert len(sizes) == 400 and max(sizes) == 30
