import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sparkload.llm import mixing, quality
from sparkload.llm.queries import domain_labels

from .test_decontaminate import least_distance
from .test_neardup import brute_force as classes_of
from .test_quality import corpus as labelled_corpus
from sparkload.llm.decontaminate import normalised

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def tables(folder, spark):
    rng = random.Random(9)
    docs, labels, _ = labelled_corpus(260)
    rows = [(i, t, "en" if i % 4 else "fr", s, len(t)) for i, t, _, s in docs]
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    items = [(k, " ".join(word() for _ in range(20))) for k in range(4)]
    rows += [(1000 + i, rows[i][1] + (" end" if i % 2 else ""), "en", "s1", 5) for i in range(0, 60, 3)]  # copies
    rows += [(2000 + i, rows[i][1] + " " + items[i % 4][1].upper(), "en", "s2", 5) for i in range(1, 30, 4)]
    rows += [(3000, None, None, None, None), (3001, "", "en", "s1", 0), (5, rows[5][1], "en", "s5", 1), (None, "ka lo mi", "en", "s1", 8)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def as_rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_stages_equal_brute_force(spark, tmp_path):
    """Every stage on what the one before returned, against plain Python on the same rows."""
    rows, items = tables(str(tmp_path), spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    before = as_rows(docs)
    model = quality.fit_quality_model(docs, labels)
    states = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{len(states)}")
        docs = spark.read.parquet(f"{tmp_path}/{len(states)}")
        states.append(docs)
        if len(states) < 5:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    scored = quality.score_documents(spark.read.parquet(f"{tmp_path}/documents.parquet"), model)
    kept = sorted(str(r.doc_id) for r in scored.filter("keep").collect())
    good = as_rows(states[0])
    assert sorted(str(r[0]) for r in good) == kept and set(good) <= set(before) and len(good) < len(before)

    label = classes_of([(r[0], r[1]) for r in good])
    single = as_rows(states[1])
    assert sorted(r[0] for r in single if r[0] is not None) == sorted(set(label.values())) and set(single) <= set(good)
    assert len(single) < len(good)

    leaks = lambda text: any(least_distance(normalised(t), normalised(text or "")) <= len(normalised(t)) * 0.05 for _, t in items)
    clean = as_rows(states[2])
    assert clean == [r for r in single if r[0] is None or not leaks(r[1])] and len(clean) < len(single)

    mixing_model = mixing.fit_domain_model(states[2], domain_labels(states[2], labels))
    times = sorted((str(r.doc_id), r.copies) for r in mixing.document_rates(states[2], mixing_model).collect())
    repeated = as_rows(states[3])
    assert set(repeated) == set(clean)
    assert sorted((str(i), sum(str(r[0]) == str(i) for r in repeated)) for i in {r[0] for r in clean}) == times

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = 0
    files = sorted(map(tuple, states[4].collect()), key=lambda r: r[1])
    want = []
    for r in repeated:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.append((str(r[0]), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for _, start, n, _ in files:
        assert start == total
        total += n
    assert sorted((str(i), n, c) for i, _, n, c in files) == sorted(want)


@pytest.mark.parametrize("rows", [0, 3])
def test_small_tables(spark, tmp_path, rows):
    documents = [(k, "the same text " * 9, "en", "s", 1) for k in range(rows)]
    spark.createDataFrame(documents, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()] == [0] * min(1, rows)
