import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkload.llm import decontaminate
from sparkload.llm.decontaminate import bits_of, find_passages, myers, normalised, pieces, without_passages


def least_distance(pattern, text):
    """Least edit distance of the pattern to any substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.text("abc ", min_size=1, max_size=90), st.text("abc ", max_size=120))
def test_myers_equals_table(pattern, text):
    errors, end = myers(bits_of(pattern), len(pattern), text)
    assert errors == least_distance(pattern, text)
    assert errors == len(pattern) or least_distance(pattern, text[:end]) == errors


@given(st.text(min_size=1, max_size=60), st.integers(0, 8))
def test_pieces_make_up_the_item(text, errors):
    found = pieces(text, min(errors, len(text) - 1))
    assert "".join(p for _, p in found) == text and len(found) == min(errors, len(text) - 1) + 1
    assert all(text[at : at + len(p)] == p and p for at, p in found)


def edited(text, n, rng):
    chars = list(text)
    for _ in range(n):
        k = rng.randrange(len(chars))
        what = rng.randrange(3)
        if what == 0:
            chars[k] = rng.choice("qz")
        elif what == 1:
            del chars[k]
        else:
            chars.insert(k, rng.choice("qz"))
    return "".join(chars)


def tables(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((12, 20, 35, 60, 9))]
    items += [(90, "too short"), (91, None), (92, ""), (None, items[0][1]), (1, items[1][1]), (0, items[2][1])]
    docs = []
    for k in range(60):
        parts = [word() for _ in range(rng.randrange(5, 60))]
        if k % 3 == 0:
            item = items[k % 5][1]
            item = edited(item, rng.randrange(0, int(len(item) * 0.08) + 1), rng)
            parts.insert(rng.randrange(len(parts)), item.upper() if k % 2 else item.replace(" ", " *** "))
        docs.append((k, " ".join(parts)))
    docs += [(70, None), (71, ""), (None, items[0][1]), (3, docs[3][1]), (72, items[1][1] + " x " * 20_000 + items[3][1])]
    return docs, items


@pytest.mark.parametrize("chars", [8_000_000, 100])
def test_pairs_equal_brute_force(spark, monkeypatch, chars):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", chars)
    docs, items = tables(1)
    want = {}
    for i, text in docs:
        for j, item in items:
            item = normalised(item or "")
            if i is not None and j is not None and len(item) >= 40:
                n = least_distance(item, normalised(text or "")) if len(text or "") < 5000 else (0 if item in normalised(text) else 99)
                if n <= int(len(item) * 0.05):
                    want[i, j] = min(n, want.get((i, j), n))
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([(j, t, 1) for j, t in items], "item_id long, text string, doc_id int")
    got = find_passages(frame, benchmark).collect()
    assert {(r.doc_id, r.item_id): r.errors for r in got} == want and len(got) == len(want) and len(want) > 10
    kept = without_passages(frame, benchmark)
    assert kept.columns == frame.columns
    leaks = {i for i, _ in want}
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == sorted(str(i) for i, _ in docs if i not in leaks)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "an item that is certainly long enough to be searched for")], "item_id long, text string")
    assert find_passages(none, items).count() == 0
    found = find_passages(spark.createDataFrame([(1, "x")], "doc_id long, text string"), items.limit(0))
    assert found.columns == ["doc_id", "item_id", "errors", "end"] and found.count() == 0


def test_short_items_are_found_exactly_as_whole_words(spark):
    items = [(1, "What is 2 + 2?"), (2, "法国的首都是哪里？"), (3, "대한민국의 수도는 어디인가"), (4, "Who?"), (5, " ?! "), (6, "ไทยแลนด์")]
    docs = [
        (1, "He asked: what is 2+2? Four."), (2, "somewhat is 2 2"), (3, "what is 2 22, and what is 2 2"), (4, "what is 3 2"), (5, "请问法国的首都是哪里呢"),
        (6, "문제: 대한민국의 수도는 어디인가?"), (7, "대한민국의 수도는 어디인가요"), (8, "WHO, whom"), (9, "whom"), (10, "?!"), (11, "รักไทยแลนด์มาก"), (12, "法国的首都"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.errors, r.end) for r in find_passages(frame, benchmark).collect()}
    assert got == {(1, 1): (0, 20), (3, 1): (0, 28), (5, 2): (0, 10), (6, 3): (0, 17), (8, 4): (0, 3), (11, 6): (0, 10)}
    assert sorted(r.doc_id for r in without_passages(frame, benchmark).collect()) == [2, 4, 7, 9, 10, 12]
