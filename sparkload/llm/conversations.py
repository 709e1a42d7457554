"""Repair of conversation structure by the cheapest edits, worked out on a grammar of all conversations.

Each row is one symbol: the initial of its role, and whether it is blank or repeated (it must go) or truncated.
Re-Pair over the symbol sequences of all conversations makes rules of two symbols each. A symbol, and so a rule,
has a transfer matrix: for each two states of the automaton of ``(s?(ua)+)?`` the least cost of passing from one
to the other over its rows, with the audit (the edits' initials) that costs it, the least in ASCII order among equals.
Matrices multiply over (min, +) with audits concatenated as ropes, so a rule is evaluated once from its two
parts, whatever number of conversations it stands in. Two audits of the same cost for the same rows and states are
never each other's beginnings, as what followed could only be inserts, which cost; so the least audit of a
product is made of least audits.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import col, held, query_partitions, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs; the last is added to a truncated row that stays
SPACES = "\\x20\\x09-\\x0D"
ROUNDS, RULES_A_ROUND, LEAST_COUNT = 6, 8, 2
RULE_MARK = 0xE000  # rules are written as characters from here on
LEAF = 64  # characters of a rope's leaf
NODES = 20_000  # matrices that a worker remembers besides the grammar's
ANSWERS, ANSWER_LENGTH = 50_000, 64  # audits that a worker remembers, of sequences up to this length
ROWS_AT_ONCE = 5_000

START, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired roles end with
_STATES = range(4)
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_ROLES = {"u": "user", "a": "assistant"}
MUST_GO = "d"


# --- ropes and matrices -------------------------------------------------------------------------

_P, _BASE = (1 << 61) - 1, 911_382_323_917_661


class Rope:
    """An immutable text of shared parts, with a hash that is made from those of its parts."""

    __slots__ = ("hash", "left", "length", "power", "right", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            self.length, self.power, self.hash = len(text), pow(_BASE, len(text), _P), 0
            for c in text:
                self.hash = (self.hash * _BASE + ord(c)) % _P
        else:
            self.length = left.length + right.length
            self.power = left.power * right.power % _P
            self.hash = (left.hash * right.power + right.hash) % _P

    def __add__(self, other: Rope) -> Rope:
        if not self.length or not other.length:
            return other if not self.length else self
        if self.length + other.length <= LEAF:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.text is not None:
                out.append(x.text)
            else:
                todo += [x.right, x.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """ASCII order; equal parts are passed over by their hashes."""
        xs, ys = [self], [other]
        while xs and ys:
            x, y = xs.pop(), ys.pop()
            if x is y or (x.length == y.length and x.hash == y.hash):
                continue
            if x.text is not None and y.text is not None:
                n = min(x.length, y.length)
                if x.text[:n] != y.text[:n]:
                    return x.text < y.text
                for rest, side in ((x.text[n:], xs), (y.text[n:], ys)):
                    if rest:
                        side.append(Rope(rest))
            elif y.text is not None or (x.text is None and x.length >= y.length):
                xs += [x.right, x.left]
                ys.append(y)
            else:
                xs.append(x)
                ys += [y.right, y.left]
        return bool(ys) and not xs


EMPTY = Rope("")
Matrix = tuple  # 4 x 4 of None or (cost, rope)


def product(a: Matrix, b: Matrix) -> Matrix:
    """Over (min, +): the cheapest way by any state between, of equal ones that of the least audit."""
    out = []
    for i in _STATES:
        row = []
        for j in _STATES:
            best = None
            for k in _STATES:
                x, y = a[i][k], b[k][j]
                if x is None or y is None:
                    continue
                cost = x[0] + y[0]
                if best is None or cost < best[0]:
                    best = (cost, x[1] + y[1])
                elif cost == best[0]:
                    audit = x[1] + y[1]
                    if audit < best[1]:
                        best = (cost, audit)
            row.append(best)
        out.append(tuple(row))
    return tuple(out)


def _matrix(ways: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return tuple(tuple((w[0], Rope(w[1])) if (w := ways.get((i, j))) else None for j in _STATES) for i in _STATES)


@cache
def inserts() -> Matrix:
    """Any inserts between two rows; more than lead from state to state never pay."""
    ways = {(i, i): (0, "") for i in _STATES}
    for i in (START, SYSTEM, ASSISTANT):
        ways[i, USER] = (INSERT, "I")
    for i in (START, SYSTEM):
        ways[i, ASSISTANT] = (2 * INSERT, "II")
    ways[USER, ASSISTANT] = (INSERT, "I")
    return _matrix(ways)


@cache
def row_matrix(symbol: str) -> Matrix:
    """Inserts before a row, then its edit. Upper case marks a truncated row; ``o`` is any other initial."""
    ways = {(i, i): (DELETE, "D") for i in _STATES}
    if symbol != MUST_GO:
        extra = TRUNCATED if symbol.isupper() else 0
        for role in _ROLES:
            ways |= {way: (REROLE + extra, "R") for way in _AFTER[role].items()}
        ways |= {way: (KEEP + extra, "K") for way in _AFTER.get(symbol.lower(), {}).items()}
    return product(inserts(), _matrix(ways))


class Repairer:
    """Matrices of a grammar, bottom-up, and the answers for sequences that are written in it."""

    def __init__(self, rules: tuple[str, ...]):
        self.rules = rules
        self.places = {c: k for k, c in enumerate([*"suaoSUAO", MUST_GO, *[chr(RULE_MARK + k) for k in range(len(rules))]])}
        self.matrices = [row_matrix(c) for c in "suaoSUAO" + MUST_GO]
        for left, right in rules:
            self.matrices.append(product(self.matrices[self.places[left]], self.matrices[self.places[right]]))
        self.fixed, self.pairs = len(self.matrices), {}
        self.answers: dict[str, tuple[int, str]] = {}

    def _pair(self, a: int, b: int) -> int:
        k = self.pairs.get((a, b))
        if k is None:
            k = self.pairs[a, b] = len(self.matrices)
            self.matrices.append(product(self.matrices[a], self.matrices[b]))
        return k

    def _solve(self, symbols: str) -> tuple[int, str]:
        nodes = [self.places[c] for c in written(symbols, self.rules)]
        while len(nodes) > 1:  # what the grammar leaves is a balanced tree, whose pairs are shared too
            pairs = [self._pair(nodes[k], nodes[k + 1]) for k in range(0, len(nodes) - 1, 2)]
            nodes = pairs + nodes[2 * len(pairs) :]
        whole = product(self.matrices[nodes[0]], inserts()) if nodes else inserts()
        cost, audit = min((w for w in (whole[START][START], whole[START][ASSISTANT]) if w), key=lambda w: (w[0], str(w[1])))
        if len(self.matrices) > self.fixed + NODES:
            del self.matrices[self.fixed :]
            self.pairs.clear()
        return cost, str(audit)

    def solve(self, symbols: str) -> tuple[int, str]:
        """Cost and audit of the cheapest repair of a sequence of rows."""
        if len(symbols) > ANSWER_LENGTH:
            return self._solve(symbols)
        if symbols not in self.answers:
            if len(self.answers) >= ANSWERS:
                self.answers.clear()
            self.answers[symbols] = self._solve(symbols)
        return self.answers[symbols]


def written(symbols: str, rules: tuple[str, ...]) -> str:
    """A sequence in a grammar's symbols: each rule in turn, from left to right."""
    for k, pair in enumerate(rules):
        symbols = symbols.replace(pair, chr(RULE_MARK + k))
    return symbols


# --- rows ---------------------------------------------------------------------------------------


def _spaced(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(" "))


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with faults made by the crc32 of ``conv_id:turn``, modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role ``user``. Nulls are one
    space in the key, the role and the text; ``conv_id`` and ``turn`` themselves stay null.
    """
    fault = F.crc32(F.concat(_spaced(conv_col), F.lit(":"), _spaced(turn_col)).cast("binary")) % 20
    text, role = _spaced(text_col), _spaced(role_col)
    faulty = rows.select(
        col(conv_col).alias("conv_id"),
        col(turn_col).cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )
    return faulty.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies", "copy")


def _prepared(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Columns of fixed names; ``print`` stands for role and text, and orders rows of one turn and role."""
    named = rows.select(col(conv_col).alias("conv"), col(turn_col).cast("long").alias("turn"), _spaced(role_col).alias("role"), _spaced(text_col).alias("text"))
    return named.withColumn("print", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))


def _faults(rows: DataFrame) -> DataFrame:
    """Rows without their texts: ``conv, turn, role, print, blank, cut, first``.

    ``first`` says that no earlier turn has the same role and text. Only prints that a conversation has several
    times are joined back; adaptive execution broadcasts them while they are few and splits skewed partitions.
    """
    light = rows.select(
        "conv",
        "turn",
        "role",
        "print",
        (~F.col("text").rlike(f"[^{SPACES}]")).alias("blank"),
        (~F.col("text").rlike(f"[.!?][{SPACES}]*\\z")).alias("cut"),
    )
    seen = light.groupBy("conv", "print").agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("low"), F.bool_or(F.col("turn").isNull()).alias("null"))
    again = seen.filter("n > 1").select(
        F.col("conv").alias("c"), F.col("print").alias("p"), F.when(~F.col("null"), F.col("low")).alias("low")
    )
    met = light.join(again, F.col("conv").eqNullSafe(F.col("c")) & (F.col("print") == F.col("p")), "left")
    return met.withColumn("first", F.col("p").isNull() | F.col("turn").eqNullSafe(F.col("low"))).drop("c", "p", "low")


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def _sequences(rows: DataFrame, conv_type: str) -> DataFrame:
    """A row for each conversation: its counts and its symbols.

    Conversations are dealt by their id and sorted by Spark; a task streams through them and holds one character a row
    of the present one, as the audit has.
    """
    n = query_partitions(rows.sparkSession)
    light = _faults(rows).select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "role", "print", "blank", "cut", "first")
    dealt = light.repartition(n, "conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "print")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "initial", "print", "blank", "cut", "first")]
            for conv, turn, initial, print_, blank, cut, first in zip(*columns):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(finished(now))
                        if len(done) >= ROWS_AT_ONCE:
                            yield batch_of(done)
                            done = []
                    # conversation, turns, counts, symbols, turn and print and initial of the row before
                    now = [conv, None, None, 0, dict.fromkeys(_COUNTS, 0), [], (), None]
                    kinds: list[str] = now[5]
                if turn is not None and turn != now[2]:
                    now[1] = turn if now[1] is None else now[1]
                    now[2] = turn
                    now[3] += 1
                counts = now[4]
                symbol = initial if initial in "sua" and initial else "o"
                if blank:
                    counts["blank"] += 1
                    symbol = MUST_GO
                elif not first or now[6] == (turn, print_):
                    counts["duplicate"] += 1
                    symbol = MUST_GO
                elif cut:
                    counts["truncated"] += 1
                    symbol = symbol.upper()
                if now[7] is not None and now[7] + initial not in ("su", "ua", "au"):
                    counts["illegal"] += 1
                now[6], now[7] = (turn, print_), initial
                kinds.append(symbol)
                if len(kinds) > 1 << 16:
                    kinds[:] = ["".join(kinds)]
        if now is not None:
            done.append(finished(now))
        if done:
            yield batch_of(done)

    def finished(now: list) -> tuple:
        conv, low, high, distinct, counts, kinds = now[:6]
        counts["gaps"] = high - low + 1 - distinct if distinct else 0
        return conv, *counts.values(), "".join(kinds)

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        conv, *counts, symbols = zip(*done)
        arrays = [pa.array(conv, pa.string() if conv_type == "string" else pa.int64())]
        arrays += [pa.array(c, pa.int64()) for c in counts] + [pa.array(symbols, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["conv", *_COUNTS, "symbols"])

    return dealt.mapInArrow(run, f"conv {conv_type}, {', '.join(f'{c} long' for c in _COUNTS)}, symbols string")


def learn_rules(sequences: DataFrame, rounds: int = ROUNDS, rules_a_round: int = RULES_A_ROUND) -> tuple[str, ...]:
    """Re-Pair over the ``symbols`` of all rows: the pairs that rules stand for.

    Each round counts all adjacent pairs where they lie (a task sends a number for each different pair; the alphabet is
    nine symbols and the rules so far) and makes rules of the most frequent ones that share no symbol with one
    another. The driver gets ``rules_a_round`` squared pairs at most. How many rules there are decides how much is
    shared, never what comes out.
    """
    distinct = stored(sequences.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "sequences")
    rules: tuple[str, ...] = ()
    for _ in range(rounds):

        def count(batches: Iterator[pa.RecordBatch], rules: tuple[str, ...] = rules) -> Iterator[pa.RecordBatch]:
            found: Counter[str] = Counter()
            for batch in batches:
                for symbols, n in zip(batch.column("symbols").to_pylist(), batch.column("n").to_pylist()):
                    text = written(symbols, rules)
                    for pair, k in Counter(map("".join, zip(text, text[1:]))).items():
                        # copies of a symbol pair up without overlap
                        k = len(re.findall(re.escape(pair), text)) if pair[0] == pair[1] else k
                        found[pair] += n * k
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array(list(found.values()), pa.int64())], ["pair", "k"])

        counted = distinct.mapInArrow(count, "pair string, k long").groupBy("pair").agg(F.sum("k").alias("k"))
        top = counted.filter(F.col("k") >= LEAST_COUNT).orderBy(F.desc("k"), "pair").limit(rules_a_round**2).collect()
        chosen: list[str] = []
        for pair, _ in top:
            if len(chosen) < rules_a_round and not set(pair) & set("".join(chosen)):
                chosen.append(pair)
        if not chosen:
            break
        rules += tuple(chosen)
    return rules


def audit_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``, stored, for each conversation of the rows.

    Rows are taken by turn, nulls first, and within a turn by role and a digest of the text. The first fault of a
    row counts: blank (nothing but white space), duplicate (an earlier row has its role and text), truncated (the last
    character other than white space is none of ``.!?``). ``gaps`` are the turns missing between the first and the
    last; ``illegal`` counts neighbours whose initials are not ``su``, ``ua`` or ``au``.

    ``audit`` spells the cheapest edits that give roles with the initials ``(s?(ua)+)?``: Keep, Rerole to user or
    assistant, Delete (required for blank and duplicate rows) and Insert of an empty user or assistant row; of equal
    cost, the least in ASCII order. A null role or text is one space; rows without a conversation are one conversation.
    """
    ship_package(rows.sparkSession)
    prepared = _prepared(rows, conv_col, turn_col, role_col, text_col)
    conv_type = "string" if dict(prepared.dtypes)["conv"] == "string" else "bigint"
    prepared = prepared.withColumn("conv", F.col("conv").cast(conv_type))
    sequences = stored(_sequences(prepared, conv_type), "conversations")
    rules = learn_rules(sequences)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = held("repair", rules, lambda: Repairer(rules))
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(k, ROWS_AT_ONCE)
                cost, audit = zip(*[repairer.solve(s) for s in part.column("symbols").to_pylist()])
                made = [part.column(c) for c in ("conv", *_COUNTS)] + [pa.array(cost, pa.int64()), pa.array(audit, pa.string())]
                yield pa.RecordBatch.from_arrays(made, ["conv_id", *_COUNTS, "cost", "audit"])

    schema = f"conv_id {conv_type}, {', '.join(f'{c} long' for c in _COUNTS)}, cost long, audit string"
    return stored(sequences.mapInArrow(solve, schema), "audits")


def repaired_rows(
    rows: DataFrame, audits: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, place, role, text``: the rows of each conversation after the edits of its audit, in order within partitions.

    An audit is sorted before the rows of its conversation and the task streams through them: no conversation is
    collected. Rows of conversations without an audit are left out.
    """
    conv_type = dict(audits.dtypes)["conv_id"]
    prepared = _prepared(rows, conv_col, turn_col, role_col, text_col).withColumn("conv", F.col("conv").cast(conv_type))
    given = audits.select(
        F.col("conv_id").alias("conv"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        F.lit(None).cast("binary").alias("print"),
        F.lit(0).alias("kind"),
    )
    n = query_partitions(rows.sparkSession)
    both = given.unionByName(prepared.withColumn("kind", F.lit(1))).repartition(n, "conv")
    ordered = both.sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "print").select("conv", "kind", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, place = None, None, 0, START, 0

        def inserted(out: list[tuple]) -> None:
            nonlocal at, state, place
            while audit is not None and audit[at : at + 1] == "I":
                initial = "a" if state == USER else "u"
                out.append((conv, place, _ROLES[initial], ""))
                at, place, state = at + 1, place + 1, _AFTER[initial][state]

        for batch in batches:
            out: list[tuple] = []
            for c, kind, role, text in zip(*[batch.column(name).to_pylist() for name in ("conv", "kind", "role", "text")]):
                if kind == 0:
                    inserted(out)  # after the last row of the conversation before
                    conv, audit, at, state, place = c, text, 0, START, 0
                    continue
                if audit is None or c != conv:
                    continue
                inserted(out)
                edit = audit[at]
                at += 1
                if edit == "D":
                    continue
                initial = role[:1] if edit == "K" else "a" if state == USER else "u"
                out.append((c, place, role if edit == "K" else _ROLES[initial], text))
                place, state = place + 1, _AFTER[initial][state]
            if out:
                yield made(out)
        out = []
        inserted(out)
        if out:
            yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        conv, place, role, text = zip(*out)
        kinds = (pa.string() if conv_type == "string" else pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((conv, place, role, text), kinds)], ["conv_id", "place", "role", "text"])

    return ordered.mapInArrow(run, f"conv_id {conv_type}, place long, role string, text string")


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` over ``role:text`` lines of frames as ``repaired_rows`` gives them, read as they lie."""
    conv_type = dict(repaired.dtypes)["conv_id"]
    kind = pa.string() if conv_type == "string" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running = None, None
        for batch in batches:
            done = []
            for c, place, role, text in zip(*[batch.column(name).to_pylist() for name in ("conv_id", "place", "role", "text")]):
                if place == 0:
                    if running is not None:
                        done.append((conv, running.hexdigest()))
                    conv, running = c, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            if done:
                yield made(done)
        if running is not None:
            yield made([(conv, running.hexdigest())])

    def made(done: list[tuple]) -> pa.RecordBatch:
        conv, digest = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(conv, kind), pa.array(digest, pa.string())], ["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(run, f"conv_id {conv_type}, repaired_sha256 string")


def repair_report(rows: DataFrame, originals: DataFrame) -> DataFrame:
    """Audits of the rows with the digest of what they give, for every ``conv_id`` of ``originals``.

    A conversation of which no row is left has zeros, an empty audit and the digest of an empty text.
    """
    audits = audit_conversations(rows)
    digests = conversation_digests(repaired_rows(rows, audits))
    numbers = [*_COUNTS, "cost"]
    every = originals.select(F.col("conv_id").alias("every")).distinct()
    found = every.join(audits, F.col("every").eqNullSafe(F.col("conv_id")), "left")
    digests = digests.withColumnRenamed("conv_id", "digested")
    found = found.join(digests, F.col("every").eqNullSafe(F.col("digested")), "left")
    return found.select(
        F.col("every").alias("conv_id"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
