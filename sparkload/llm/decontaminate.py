"""Benchmark passages in documents, found within an edit distance by exact pieces and bit-parallel verification."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, id_and_text, map_texts, without_ids

ERROR_RATE = 0.05  # edits allowed, as a share of an item's normalised length
LEAST_LENGTH = 40  # normalised characters; shorter items are searched for without errors, as whole words
BLOCK_CHARS = 8_000_000  # benchmark text in one automaton

_OTHER = re.compile(r"[\W_]+")
# Scripts written without spaces (Thai to Myanmar, Khmer, kana and Han): a word may begin or end anywhere.
_UNSPACED = re.compile("[\u0e00-\u0eff\u0f00-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def normalised(text: str) -> str:
    """Lower-case letters and digits, words parted by one space: case and punctuation are no edits."""
    return _OTHER.sub(" ", text.lower()).strip()


def pieces(text: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length, with their places.

    Whatever ``errors`` edits do, they leave one piece untouched, so a match contains it exactly.
    """
    cuts = [len(text) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def at_boundary(text: str, at: int) -> bool:
    """Whether a word may begin or end at this place of a normalised text."""
    if at <= 0 or at >= len(text) or " " in text[at - 1 : at + 1]:
        return True
    return bool(_UNSPACED.search(text[at - 1 : at + 1]))


def myers(pattern_bits: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of ``text``, and where the first such ends.

    Columns of the distance table are kept as two bit vectors of vertical differences.
    """
    mask, high = (1 << length) - 1, 1 << (length - 1)
    up, down, score = mask, 0, length
    best, best_end = length, 0
    for end, char in enumerate(text, 1):
        equal = pattern_bits.get(char, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | (mask & ~(horizontal | up))
        minus = up & horizontal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = (plus << 1) & mask, (minus << 1) & mask
        up = minus | (mask & ~(vertical | plus))
        down = plus & vertical
        if score < best:
            best, best_end = score, end
    return best, best_end


def bits_of(pattern: str) -> dict[str, int]:
    bits: dict[str, int] = {}
    for i, char in enumerate(pattern):
        bits[char] = bits.get(char, 0) | 1 << i
    return bits


@dataclass(frozen=True)
class Item:
    item_id: int
    text: str
    errors: int
    exact: bool = False  # whole words only


class PassageFinder:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: tuple[Item, ...]):
        import ahocorasick

        self.items = items
        self.bits = [bits_of(x.text) for x in items]
        self.machine = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for k, item in enumerate(items):
            for at, piece in pieces(item.text, item.errors):
                owners.setdefault(piece, []).append((k, at))
        for piece, where in owners.items():
            self.machine.add_word(piece, (len(piece), where))
        self.machine.make_automaton()

    def windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """Item and the part of the text that must hold a match, for all piece hits; overlapping parts are joined."""
        found: dict[int, list[tuple[int, int]]] = {}
        for end, (length, where) in self.machine.iter(text):
            begin = end + 1 - length
            for k, at in where:
                item = self.items[k]
                # The first hit of an exact item is its match.
                if item.exact and (k in found or not (at_boundary(text, begin) and at_boundary(text, end + 1))):
                    continue
                low = max(0, begin - at - item.errors)
                high = min(len(text), begin - at + len(item.text) + item.errors)
                spans = found.setdefault(k, [])
                if spans and low <= spans[-1][1] and low >= spans[-1][0]:
                    if high > spans[-1][1]:
                        spans[-1] = (spans[-1][0], high)
                else:
                    spans.append((low, high))
        for k, spans in found.items():
            for low, high in spans:
                yield k, low, high

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """``(item_id, errors, end)`` of the best match of every item within its error budget."""
        best: dict[int, tuple[int, int]] = {}
        for k, low, high in self.windows(text):
            item = self.items[k]
            if best.get(k, (1,))[0] == 0:
                continue
            errors, end = myers(self.bits[k], len(item.text), text[low:high])
            if errors <= item.errors:
                best[k] = min(best.get(k, (errors, low + end)), (errors, low + end))
        return [(self.items[k].item_id, errors, end) for k, (errors, end) in best.items()]


def finder(items: tuple[Item, ...]) -> PassageFinder:
    return held("passages", items, lambda: PassageFinder(items))


def _item_blocks(benchmark: DataFrame, item_id: str, text_col: str, rate: float, least: int) -> Iterator[tuple[Item, ...]]:
    """The items in blocks of at most ``BLOCK_CHARS`` characters (or one item), read one partition at a time."""
    rows = id_and_text(benchmark, item_id, text_col).filter("id is not null").distinct()
    block, size = [], 0
    for row in rows.toLocalIterator():
        text = normalised(row.text)
        if not text:
            continue
        if block and size + len(text) > BLOCK_CHARS:
            yield tuple(block)
            block, size = [], 0
        exact = len(text) < least
        block.append(Item(row.id, text, 0 if exact else int(len(text) * rate), exact))
        size += len(text)
    if block:
        yield tuple(block)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    least_length: int = LEAST_LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, errors, end``: every pair of a document and an item found in it.

    Texts are compared as lower-case words. An item matches where some part of the document is within
    ``rate`` times its length in edits. The benchmark is a query set: it is searched for in blocks of
    bounded size, each in one pass over the documents without a shuffle. ``errors`` and ``end`` (in the normalised text) are those of
    the best match. Items shorter than ``least_length`` match only exactly and as whole words; in scripts without spaces words
    may begin and end anywhere. Null or empty items and documents are never found; repeated
    rows on either side give their pair once; rows without an id on either side take no part.
    """
    schema = "doc_id long, item_id long, errors int, end long"
    texts = id_and_text(docs, id_col, text_col).filter("id is not null")
    found = None
    for items in _item_blocks(benchmark, item_id, item_text, rate, least_length):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            find = finder(shared.value).find
            rows = [
                (doc, *match)
                for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist())
                for match in find(normalised(text))
            ]
            doc, item, errors, end = zip(*rows) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(errors, pa.int32()), pa.array(end, pa.int64())],
                ["doc_id", "item_id", "errors", "end"],
            )

        part = map_texts(texts, run, schema)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    best = F.min(F.struct("errors", "end")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.errors", "best.end")


def without_passages(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no item was found, with all their columns; rows without an id are kept."""
    found = find_passages(docs, benchmark, **options)
    return without_ids(docs, found.select("doc_id"), options.get("id_col", "doc_id"))
