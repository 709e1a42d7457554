import math

import numpy as np
import pytest

from sparkload.llm import ann


def clustered(n=2000, d=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d)) * 2
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, d))
    return x * rng.uniform(0.5, 2.0, (n, 1))


def brute_force(vectors, queries, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids])
    out = {}
    for q in queries:
        scores = ann.inner_products(np.array(vectors[q]), x)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def results(frame):
    got = {}
    for r in frame.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    return got


@pytest.fixture(scope="module")
def index_of(spark):
    def make(vectors, **options):
        frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in vectors.items()], "vec_id long, embedding array<double>")
        return ann.build_index(frame.repartition(3), **options)

    return make


def test_recall_and_exact_scores(spark, index_of):
    vectors = dict(enumerate(clustered()))
    index = index_of(vectors, sample_rows=800, leaf_rows=40)
    asked = index.rows.filter("id % 20 = 0").select("id", "v")
    index = ann.calibrate(index, asked, 10, target=0.97, sample=60)
    assert index.tree.leaves > 10 and index.recall >= 0.97 and index.visits < index.tree.leaves
    want = brute_force(vectors, [i for i in vectors if i % 20 == 0], 10)
    got = results(ann.search(index, asked, 10))
    hits = sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    for q, rows in got.items():
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1))
        assert [s for _, _, s in rows] == sorted((s for _, _, s in rows), reverse=True)
        for _, i, s in rows:
            assert i != q and s == pytest.approx(float(np.dot(vectors[q], vectors[i])))


def test_all_leaves_are_exhaustive_with_ties_and_split_leaves(spark, index_of):
    vectors = dict(enumerate(clustered(600)))
    vectors |= {1000 + k: np.ones(16) * 3 for k in range(300)}  # copies of one vector
    index = index_of(vectors, sample_rows=300, leaf_rows=30, block_rows=50)
    assert max(index.blocks.values()) > 3
    asked = index.rows.filter("id % 20 = 0").select("id", "v")
    want = brute_force(vectors, [i for i in vectors if i % 20 == 0], 7)
    got = results(ann.search(index, asked, 7, visits=index.tree.leaves, query_rows=9))
    assert {q: [i for _, i, _ in rows] for q, rows in got.items()} == {q: [i for i, _ in rows] for q, rows in want.items()}
    assert results(ann.exhaustive(index.rows, asked, 7)) == got


def test_unusable_rows_take_no_part(spark):
    rows = [(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 0.0]), (3, None), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, []), (1, [0.5, 0.5]), (9, [0.5, 0.5]), (40, [0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, leaf string")
    index = ann.build_index(frame)
    asked = index.rows.filter("id % 20 = 0").select("id", "v")
    got = results(ann.search(ann.calibrate(index, asked, 20), asked, 20))
    assert got == {20: [(1, 7, 1.0), (2, 1, 0.5), (3, 9, 0.5)]}  # a shorter vector takes part, with zeros behind


def test_empty_table(spark):
    index = ann.build_index(spark.createDataFrame([], "vec_id long, embedding array<double>"))
    asked = index.rows.select("id", "v")
    found = ann.search(ann.calibrate(index, asked, 5), asked, 5)
    assert found.columns == ["query_id", "rank", "id", "score"] and found.count() == 0


def test_visits_are_a_permutation_of_the_leaves():
    x = clustered(900)
    tree = ann.fit_tree(x, float((x**2).sum(axis=1).max()), leaf_rows=30)
    for q in x[:20]:
        order = tree.visits(q, tree.leaves)
        assert sorted(order) == list(range(tree.leaves)) and tree.visits(q, 3) == order[:3]
    assert set(tree.leaf_of(x).tolist()) <= set(range(tree.leaves))


def test_one_visit_still_gives_k_rows(spark, index_of):
    """A dense crowd and a few rows far off: leaves of one row or two must not leave a query with fewer than k."""
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(600, 4)) * 0.01 + 1, rng.normal(size=(40, 4)) * 30])
    vectors = dict(enumerate(x))
    index = index_of(vectors, sample_rows=10_000, leaf_rows=4)
    got = results(ann.search(index, index.rows.filter("id % 7 = 0 or id >= 600").select("id", "v"), 20, visits=1))
    assert min(index.counts.values()) < 20 and {len(rows) for rows in got.values()} == {20}
    few = index_of(dict(enumerate(x[:5])))
    assert {len(r) for r in results(ann.search(few, few.rows.select("id", "v"), 20)).values()} == {4}


def test_vectors_of_several_lengths_are_all_searched(spark, index_of):
    vectors = {k: [1.0 + k, 2.0, 3.0][: 2 + k % 2] for k in range(8)}
    index = index_of(vectors)
    got = results(ann.search(index, index.rows.select("id", "v"), 10))
    assert len(got) == 8 and all(len(rows) == 7 for rows in got.values())
    for q, rows in got.items():
        for _, i, s in rows:
            assert s == pytest.approx(sum(a * b for a, b in zip(vectors[q], vectors[i])))


def test_many_split_leaves(spark, index_of):
    """Where most of many leaves are split, as at some GB, the plan must not grow as deep as there are leaves."""
    vectors = dict(enumerate(np.random.default_rng(3).normal(size=(4000, 4))))
    index = index_of(vectors, sample_rows=4000, leaf_rows=8, block_rows=2)
    assert sum(n > 1 for n in index.blocks.values()) > 400
    asked = index.rows.filter("id % 500 = 0").select("id", "v")
    want = brute_force(vectors, [i for i in vectors if i % 500 == 0], 5)
    got = results(ann.search(index, asked, 5, visits=index.tree.leaves, query_rows=3))
    assert {q: [i for _, i, _ in rows] for q, rows in got.items()} == {q: [i for i, _ in rows] for q, rows in want.items()}
