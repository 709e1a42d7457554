import math
import random

import numpy as np
import pytest

from sparkload.llm import quality
from sparkload.llm.quality import fit_logistic, fit_quality_model, keep_good, score_documents, site_posteriors


def corpus(n=900, seed=1):
    """Documents, and labels of two thirds of them; junk is loud or repetitive, toxic texts hold certain words."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "ru", "ta") for b in ("n", "s", "ra", "li", "to", "du", "me")]
    bad = ["vile", "nasty", "rotten"]
    docs, truth = [], {}
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        good, toxic = rng.random() > 0.2, rng.random() < 0.15
        if not good:
            text = [w.upper() + "!!" for w in text] if rng.random() < 0.5 else [text[0]] * len(text)
        if toxic:
            for w in rng.sample(bad, 2):
                text.insert(rng.randrange(len(text)), w)
        docs.append((i, " ".join(text), "en", f"s{i % 7}"))
        truth[i] = (int(good), int(toxic))
    labels = [(i, q, t) for i, (q, t) in truth.items() if i % 3]
    return docs, labels, truth


SCHEMA = "doc_id long, text string, lang string, source string"


def test_held_out_accuracy(spark):
    docs, labels, truth = corpus()
    frame = spark.createDataFrame(docs, SCHEMA)
    model = fit_quality_model(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows=150)
    got = {r.doc_id: r for r in score_documents(frame, model).collect()}
    held_out = [i for i in truth if i % 3 == 0]
    right = [(got[i].p_good >= 0.5) == bool(truth[i][0]) for i in held_out], [(got[i].p_toxic >= 0.5) == bool(truth[i][1]) for i in held_out]
    assert np.mean(right[0]) > 0.97 and np.mean(right[1]) > 0.95
    assert all(r.keep == (r.p_good >= 0.5 and r.p_toxic < 0.5) for r in got.values())


def test_keep_good_agrees_and_keeps_columns(spark):
    docs, labels, _ = corpus(300)
    rows = [(*d, "extra", 5) for d in docs] + [(None, docs[1][1], None, None, "x", 1), (1, docs[1][1], "en", "s1", "y", 2), (901, None, "en", "s1", "z", 3), (902, "", None, "s2", "z", 3)]
    frame = spark.createDataFrame(rows, SCHEMA + ", row string, good int")
    model = fit_quality_model(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows=100)
    scored = score_documents(frame, model).collect()
    kept = keep_good(frame, model)
    assert kept.columns == frame.columns and len(scored) == len(rows)
    assert sorted(str(r.doc_id) for r in scored if r.keep) == sorted(str(r.doc_id) for r in kept.collect())


@pytest.mark.parametrize("labels", [[], [(1, None, 0)], [(1, 1, 0), (2, 1, 0)], [(77_000, 1, 1)]])
def test_few_or_no_labels_keep_what_nothing_speaks_against(spark, labels):
    frame = spark.createDataFrame(corpus(12)[0], SCHEMA)
    model = fit_quality_model(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert [r.keep for r in score_documents(frame, model).collect()] == [True] * 12
    assert score_documents(frame.limit(0), model).count() == 0 and keep_good(frame.limit(0), model).columns == frame.columns


def test_posteriors_shrink_sparse_sites(spark):
    """A large host keeps its own share; a path of one document is near its host's, a host of one near the common share."""
    logit = lambda p: math.log(p / (1 - p))
    rows = [("good", "good/a", 0.95)] * 400 + [("bad", "bad/a", 0.1)] * 400 + [("mid", f"mid/{k % 40}", 0.6) for k in range(400)]
    rows += [("bad", "bad/rare", 0.95), ("one", "one/a", 0.95)]
    scored = spark.createDataFrame([(h, p, logit(x)) for h, p, x in rows], "host string, path string, good double")
    got = {r.path: r.prior_good for r in site_posteriors(scored, {"good": 0.5}).collect()}
    assert got["good/a"] > 0.9 and got["bad/a"] < 0.15
    assert got["bad/rare"] < 0.5 and 0.3 < got["one/a"] < 0.9


def test_logistic_regression_finds_the_optimum():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 3)) * [1, 5, 0.2] + [0, 2, 0]
    truth = np.array([1.5, -0.4, 3.0])
    y = (rng.random(4000) < 1 / (1 + np.exp(-(x @ truth + 0.3)))).astype(float)
    bias, weights = fit_logistic(x, y, np.ones(4000), ridge=1e-6)
    p = 1 / (1 + np.exp(-(x @ weights + bias)))
    assert np.abs(x.T @ (p - y)).max() < 1e-3 * 4000
    assert np.abs(weights - truth).max() < 0.4


def test_training_sample_is_bounded(spark, monkeypatch):
    docs, labels, _ = corpus(600)
    seen = []
    original = quality.fit_logistic
    monkeypatch.setattr(quality, "fit_logistic", lambda x, y, w, **k: seen.append(len(x)) or original(x, y, w, **k))
    fit_quality_model(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows=20)
    assert max(seen) < 4 * 20 * 2
