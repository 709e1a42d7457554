import hashlib
import random
import re
import zlib
from itertools import product as combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkload.llm import conversations as C

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, audit string, print string"


def cheapest(symbols):
    """Cost and audit by strings kept for every state after every row."""
    edges = {("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3, ("s", 0): 1}

    def spread(best):
        for _ in range(3):
            for (initial, i), j in edges.items():
                if initial != "s" and i in best:
                    way = (best[i][0] + 2, best[i][1] + "I")
                    best[j] = min(best.get(j, way), way)
        return best

    best = spread({0: (0, "")})
    for s in symbols:
        following = {}
        for i, (cost, audit) in best.items():
            ways = [(i, cost + 3, "D")]
            if s != "d":
                cut = s.isupper()
                ways += [(edges[r, i], cost + 2 + cut, "R") for r in "ua" if (r, i) in edges]
                ways += [(edges[s.lower(), i], cost + cut, "K")] if (s.lower(), i) in edges else []
            for j, c, edit in ways:
                following[j] = min(following.get(j, (c, audit + edit)), (c, audit + edit))
        best = spread(following)
    return min(best[i] for i in (0, 3) if i in best)


def exhaustive(symbols):
    """All edits with at most two inserts in each place."""
    best = None
    for edits in combinations("DKR", repeat=len(symbols)):
        for n_inserts in combinations(range(3), repeat=len(symbols) + 1):
            roles, cost, audit = [[]], 0, ""
            for k, (s, e) in enumerate(zip([*symbols, None], [*edits, ""])):
                choices = ["u", "a"]
                for _ in range(n_inserts[k]):
                    roles = [r + [c] for r in roles for c in choices]
                    cost, audit = cost + 2, audit + "I"
                if s is None:
                    break
                audit += e
                if e != "D" and s == "d":
                    roles = []
                    break
                cost += {"D": 3, "K": 0, "R": 2}[e] + (e != "D" and s.isupper())
                roles = roles if e == "D" else [r + [c] for r in roles for c in ([s.lower()] if e == "K" else choices)]
            if any(re.fullmatch("(s?(ua)+)?", "".join(r)) for r in roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_strings_equal_all_edits():
    for n in range(4):
        for symbols in combinations("suaoUd", repeat=n):
            if n < 3 or hash(symbols) % 6 == 0:
                assert cheapest(symbols) == exhaustive(symbols)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="suaoSUAOd", max_size=30), st.integers(0, 5))
def test_grammar_equals_strings(symbols, n):
    rules = ("ua", "\ue000\ue000", "sU", "dd", "\ue001o")[:n]
    assert C.Repairer(rules).solve(symbols) == cheapest(symbols)


def test_long_sequences_and_ropes():
    rng = random.Random(2)
    for alphabet in ("ua", "uadSo", "uuuad"):
        symbols = "".join(rng.choices(alphabet, k=3_000))
        repairer = C.Repairer(("ua", "\ue000\ue000", "uu", "\ue002d"))
        assert repairer.solve(symbols) == cheapest(symbols)


@settings(max_examples=200, deadline=None)
@given(st.text("DIKR", max_size=20), st.text("DIKR", max_size=20), st.lists(st.integers(0, 20), max_size=4))
def test_ropes_are_ordered_as_texts(a, b, cuts):
    def rope(text, cuts):
        if not cuts:
            return C.Rope(text)
        at = min(cuts[0], len(text))
        left, right = rope(text[:at], cuts[1:]), rope(text[at:], cuts[2:])
        return C.Rope(None, left, right)

    x, y = rope(a, cuts), rope(b, cuts[::-1])
    assert str(x) == a and (x < y) == (a < b) and (x.hash == y.hash) == (a == b)


def brute_force(rows):
    out, convs = [], {r[0] for r in rows}
    after = []
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        fault = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        after += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for conv in convs:
        mine = [r[1:] for r in after if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns = {t for t, _, _ in mine if t is not None}
        seen, symbols, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in mine:
            symbol = role[:1] if role[:1] in ("s", "u", "a") else "o"
            body = text.rstrip(" \t\n\v\f\r")
            if not body:
                counts["blank"] += 1
                symbol = "d"
            elif (role, text) in seen:
                counts["duplicate"] += 1
                symbol = "d"
            elif body[-1] not in ".!?":
                counts["truncated"] += 1
                symbol = symbol.upper()
            seen.add((role, text))
            symbols += symbol
        cost, audit = cheapest(symbols)
        initials = [r[:1] for _, r, _ in mine]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        lines, rest, last = [], iter(mine), ""
        for edit in audit:
            row = next(rest) if edit != "I" else None
            if edit == "D":
                continue
            role = row[1] if edit == "K" else "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{row[2] if row else ''}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest))
    return out


def conversation_rows():
    rng = random.Random(4)
    texts = ["Hello there.", "What?", "cut off", " \t", "", None, "Yes!\n", "no-break ", "日本。", "Long. " * 3_000]
    rows = []
    for conv in [None, *range(150)]:
        turns = rng.choice([range(6), [0, 1, 1, 2, 5, None], [3], [None, None], [7, 9, 10]])
        for turn in turns:
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), rng.choice(texts)))
    rows += [(500, t, "user" if t % 2 == 0 else "assistant", f"Turn {t % 900}.") for t in range(2_000)]  # a hot one
    rows += rows[:40]
    return rows


def test_report_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "ROWS_AT_ONCE", 50)
    rows = conversation_rows()
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(5)
    found = C.repair_report(C.damaged(table), table)
    assert found.columns == COLUMNS
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute_force(rows), key=key)


def test_conversations_that_vanish(spark):
    conv = next(c for c in range(1_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(conv, 0, "user", "Gone.")], "conv_id long, turn long, role string, text string")
    (row,) = C.repair_report(C.damaged(table), table).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_rules_come_from_all_conversations(spark):
    sequences = spark.createDataFrame([("uaua",)] * 5 + [("suaua",)] * 3 + [("dd",)], "symbols string")
    rules = C.learn_rules(sequences, rounds=2)
    assert rules[0] == "ua" and "\ue000\ue000" in rules


@pytest.mark.parametrize("kind", ["long", "string"])
def test_empty_table(spark, kind):
    table = spark.createDataFrame([], f"conv_id {kind}, turn long, role string, text string")
    found = C.repair_report(C.damaged(table), table)
    assert found.columns == COLUMNS and found.count() == 0
