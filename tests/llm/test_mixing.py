import random

import numpy as np
import pytest

from sparkload.llm.mixing import (
    copies_of,
    document_rates,
    domain_totals,
    fit_domain_model,
    fit_rates,
    mixed,
    smoothed_targets,
)
from pyspark.sql import functions as F

SOUNDS = {"x": "ka lo mi ne", "y": "thu wer zop", "z": "äö ünt grä"}


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        domain = rng.choices("xyz", (6, 3, 1))[0]
        syllables = SOUNDS[domain].split()
        rows.append((i, " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 90))), domain))
    return rows


def test_rates_equal_projected_gradient_in_one_place(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.4, 0.4, 0.4], 300)
    n = rng.integers(1, 900, 300)
    members = spark.createDataFrame([(x.tolist(), int(k)) for x, k in zip(p, n)], "p array<double>, n_tokens long")
    sizes = (p * n[:, None]).sum(axis=0)
    assert domain_totals(members, 3) == pytest.approx(sizes.tolist())
    for targets, least in ((sizes * [2, 1, 0.7], 0.0), (sizes * [1, 1.5, 0.2], 0.6)):
        rates = fit_rates(members, targets.tolist(), least, steps=60)
        r = np.ones(300)
        for _ in range(20_000):  # plain projected gradient
            r = np.maximum(least, r - p @ ((p.T @ (n * r) - targets) / sizes))
        loss = lambda t: float((((np.array(t) - targets) ** 2) / sizes).sum())
        # met targets are met; of those out of reach the loss comes near its least value
        assert loss(rates.totals) <= 1.15 * loss(p.T @ (n * r)) + 1e-6 * sizes.sum()
        got = [x.r for x in members.select(rates.column(F.col("p")).alias("r")).collect()]
        assert min(got) >= least and rates.totals == pytest.approx((p.T @ (n * np.array(got))).tolist())


def test_totals_meet_targets(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, d, 1.0) for i, t, d in rows], "doc_id long, text string, lang string, rate double")
    labelled = spark.createDataFrame([(i, d) for i, _, d in rows if i % 2], "doc_id long, domain string")
    model = fit_domain_model(docs, labelled, rows=60)
    got = document_rates(docs, model).collect()
    truth = {i: d for i, _, d in rows}
    held_out = [r for r in got if r.doc_id % 2 == 0]
    assert np.mean([r.domain == truth[r.doc_id] for r in held_out]) > 0.97
    size = {d: sum(len(t.split()) for _, t, e in rows if e == d) for d in "xyz"}
    want = dict(zip("xyz", smoothed_targets([size[d] for d in "xyz"])))
    for d in "xyz":
        assert sum(r.rate * r.n_tokens for r in got if truth[r.doc_id] == d) == pytest.approx(want[d], rel=0.05)
        assert sum(r.copies * r.n_tokens for r in got if truth[r.doc_id] == d) == pytest.approx(want[d], rel=0.15)
    assert min(r.rate for r in got) >= 1.0 and min(r.copies for r in got) >= 1


def test_rows_are_repeated_and_none_dropped(spark):
    rows = [(i, t, d, k) for k, (i, t, d) in enumerate(corpus(120))] + [(None, "ka lo", "x", 500), (3, "ka lo mi", "x", 501), (901, None, None, 502), (902, "", "y", 503)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, copy int")
    model = fit_domain_model(docs, docs.selectExpr("doc_id", "lang AS domain"), rows=40)
    got = mixed(docs, model)
    assert got.columns == docs.columns
    counts = {}
    for r in got.collect():
        counts[r.copy] = counts.get(r.copy, 0) + 1
    want = sorted((str(r.doc_id), r.copies) for r in document_rates(docs, model).collect())
    assert sorted((str(rows[k][0]) if k < 120 else str(dict((r[3], r[0]) for r in rows)[k]), n) for k, n in counts.items()) == want


def test_copies_average_to_the_rate(spark):
    n = spark.range(20_000).select(F.sum(copies_of(F.lit(2.3), F.col("id")))).first()[0]
    assert n / 20_000 == pytest.approx(2.3, abs=0.02)


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame(corpus(9), "doc_id long, text string, lang string")
    labelled = spark.createDataFrame([], "doc_id long, domain string")
    model = fit_domain_model(docs, labelled)
    assert [(r.domain, r.copies) for r in document_rates(docs, model).collect()] == [("", 1)] * 9
    assert mixed(docs, model).count() == 9 and mixed(docs.limit(0), model).count() == 0
    assert document_rates(docs.limit(0), model).count() == 0


def test_any_number_of_domains(spark, monkeypatch):
    monkeypatch.setattr("sparkload.llm.mixing.SAMPLE_ROWS", 300)
    monkeypatch.setattr("sparkload.llm.mixing.ROWS_AT_ONCE", 50)
    names = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(150)]
    rows = [(i, " ".join([names[i % 150] * 3] * (5 + i % 7)), names[i % 150]) for i in range(900)] + [(5000, "rare words", "misspelt")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_domain_model(docs, docs.selectExpr("doc_id", "lang AS domain"))
    assert model.domains == sorted({*names, "misspelt"})
    got = document_rates(docs, model).collect()
    assert len(got) == len(rows) and min(r.copies for r in got) >= 1
    truth = {i: d for i, _, d in rows}
    assert np.mean([r.domain == truth[r.doc_id] for r in got]) > 0.9
    assert mixed(docs, model).count() == sum(r.copies for r in got)
