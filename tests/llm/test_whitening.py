import math

import numpy as np
import pytest

from sparkload.llm import whitening
from sparkload.llm.whitening import whitened_embeddings

NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
SCHEMA = "vec_id long, embedding array<float>, component string, x string"


def brute_force(rows, components=16):
    """``{id: (deviations, projections up to sign)}``, shares, and the size of the fit list."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in ok]
    fit = sorted(set(x for _, x in xs))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = lambda x: np.array([(n * c - s) / n for c, s in zip(x, sums)])
    a = np.array([centred(x) for x in fit])
    e, u = np.linalg.eigh(a.T @ a / n)
    e, u = e[::-1], u[:, ::-1]
    out = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), centred(x) @ u[:, :components] / np.sqrt(e[:components])) for i, x in xs]
    return n, e / e.sum(), out


def compare(found, rows, d, components=16):
    n, shares, want = brute_force(rows, components)
    k = min(components, d)
    assert found.columns == NAMES and found.count() == k * len(want)
    got = {}
    for r in found.collect():
        assert r.n == n and r.explained == pytest.approx(shares[r.component - 1], rel=1e-9) and 0 <= r.identity_error < 1e-9
        got.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    signs = np.zeros(k)
    for i, deviation, z in want:
        for c in range(k):
            values = got[i, deviation][c + 1]
            if not signs[c]:
                signs[c] = np.sign(values[0] * z[c])
            assert any(v == pytest.approx(signs[c] * z[c], rel=1e-7, abs=1e-8) for v in values)


def sample(n=400, d=20, seed=3):
    rng = np.random.default_rng(seed)
    scale = np.linspace(0.2, 2.0, d)
    return [(i, (rng.normal(size=d) * scale).astype(np.float32).tolist()) for i in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 32)
    rows = sample()
    rows += [(7, rows[7][1]), (9_000, rows[7][1]), (None, rows[8][1])] + [(10_000 + i, rows[0][1]) for i in range(150)]
    bad = [(1, None), (2, [None] + rows[0][1][1:]), (3, [float("nan")] * 20), (4, [float("inf")] + rows[0][1][1:])]
    docs = spark.createDataFrame([(*r, "clash", None) for r in rows + bad], SCHEMA).repartition(5)
    compare(whitened_embeddings(docs), rows, 20)


def test_slabs_equal_one_matrix(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "SLAB_ROWS", 100)
    rows = sample(300, 5)
    compare(whitened_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)), rows, 5)


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=3) * 1e9).astype(np.float32).tolist()) for i in range(50)]
    found = whitened_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    n, _, want = brute_force(rows)
    got = {r.vec_id: r.deviation for r in found.collect()}
    assert any(w > 2**63 for _, w, _ in want)
    assert all(got[i] == (w if w < 2**63 else None) for i, w, _ in want)


def test_no_variance(spark):
    same = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in whitened_embeddings(same).collect()} == {(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)}
    line = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    found = sorted(map(tuple, whitened_embeddings(line).collect()), key=lambda r: (r[1], r[0]))
    assert [abs(r[4]) for r in found[:2]] == pytest.approx([1, 1]) and [r[4] for r in found[2:]] == [None, None]
    assert [r[5] for r in found] == [1, 1, 0, 0] and found[0][3] == 64**2


def test_empty_and_lengths(spark):
    for rows in ([], [(1, None, None, None)], [(1, [], None, None)]):
        found = whitened_embeddings(spark.createDataFrame(rows, SCHEMA))
        assert found.columns == NAMES and found.count() == 0
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitened_embeddings(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>"))
