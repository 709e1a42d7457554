"""Removal of repeated passages: runs of sentences that an earlier document has, or the same one further up."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, map_texts, stored

RUN = 3  # consecutive parts, at least
LEAST_WORDS = 25  # of a run, at least: shorter ones repeat by chance
LONGEST_PART = 10  # words; a longer part is cut
WINDOW = 8  # neighbouring words of a longer part, behind one of which it is cut
ROWS_AT_ONCE = 200_000

# Marks that end a sentence or a part of one, in many scripts; spaces that may follow; scripts without
# spaces between words, as ranges.
ENDS = ".!?,;:…\n。！？，、；：．｡､؟،؛۔।॥።։"
SPACES = " \t\r\n\f\v　"
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))

# A sentence, or its part up to a comma, semicolon or colon: a passage pasted into the middle of a sentence
# then shares all its parts but the outermost with where it came from.
_SENTENCE = re.compile(f"[^{ENDS}]*[{ENDS}]+[{SPACES}]*|[^{ENDS}]+")
_UNSPACED = "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNSPACED) + "]"
_HAS_UNSPACED = re.compile(_UNSPACED)
_WORD = r"[^\W_]+"
_ANY_WORD = f"{_UNSPACED}|(?:(?!{_UNSPACED})[^\\W_])+"
_WORDS = {False: re.compile(_WORD), True: re.compile(_ANY_WORD)}
_TOKENS = {k: re.compile(rf"[\W_]*(?:{w})(?:[\W_]+\Z)?") for k, w in ((False, _WORD), (True, _ANY_WORD))}
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _cuts(words: list[str]) -> list[int]:
    """Behind which words a long part is cut: in each window, the last of the words that are least in alphabetical order.

    The choice depends on the words of the window alone, so a passage is cut alike wherever it stands.
    """
    found, least = [], -1
    for end in range(WINDOW - 1, len(words)):
        if least <= end - WINDOW:
            window = words[end - WINDOW + 1 : end + 1]
            least = end - window[::-1].index(min(window))
        elif words[end] <= words[least]:
            least = end
        else:
            continue
        found.append(least + 1)
    return [c for c in found if c < len(words)]


def _words_of(text: str) -> tuple[str, bool]:
    """The text in lower case if its words are the same in it, and whether characters are words."""
    low = text.lower()
    if len(low) != len(text) or "Σ" in text:  # letters that become several, or that depend on what follows
        low = ""
    return low, _HAS_UNSPACED.search(text) is not None


def pieces_of(text: str) -> tuple[list[int], list[str]]:
    """Number of words of each part of a text that holds any, and the words themselves, in lower case.

    Parts end behind ``ENDS``; one of more than ``LONGEST_PART`` words is cut further. Where a script has no
    spaces, each character is a word.
    """
    low, unspaced = _words_of(text)
    find = _WORDS[unspaced].findall
    sizes: list[int] = []
    pieces: list[str] = []
    for part in _SENTENCE.findall(low or text):
        words = find(part)
        n = len(words)
        if not n:
            continue
        if not low:
            words = [w.lower() for w in words]
        if n <= LONGEST_PART:
            sizes.append(n)
            pieces.append(" ".join(words))
        else:
            begin = 0
            for end in (*_cuts(words), n):
                sizes.append(end - begin)
                pieces.append(" ".join(words[begin:end]))
                begin = end
    return sizes, pieces


def parts_of(text: str) -> list[tuple[str, bool]]:
    """The parts of a text with what follows them, joined they are the text again, and whether each one holds words."""
    unspaced = _words_of(text)[1]
    out: list[tuple[str, bool]] = []
    for part in _SENTENCE.findall(text):
        words = [w.lower() for w in _WORDS[unspaced].findall(part)]
        if len(words) <= LONGEST_PART:
            out.append((part, bool(words)))
            continue
        tokens, begin = _TOKENS[unspaced].findall(part), 0
        for end in (*_cuts(words), len(words)):
            out.append(("".join(tokens[begin:end]), True))
            begin = end
    return out


def run_hashes(sizes: list[int], pieces: list[str], run: int = RUN, least_words: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and last part of the run from each part with words on.

    A run goes on until it has ``run`` parts and ``least_words`` words; parts without words do not break it. The hash
    is that of its parts' words in order. Runs that reach the end of the text before have none, so there are fewer
    runs than parts.
    """
    n = len(sizes)
    if n < run or sum(sizes) < least_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.zeros(n + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    last = np.maximum(np.searchsorted(ends, ends[:-1] + least_words) - 1, np.arange(run - 1, n + run - 1))
    last = last[: int(np.searchsorted(last, n))]  # it grows with the start
    hashes = np.array([xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")) for p in pieces], np.uint64)
    power, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power[:n], out=sums[1:])
    n_runs = len(last)
    out = (sums[last + 1] - sums[:n_runs]) * inverse[:n_runs] + (last - np.arange(n_runs)).astype(np.uint64)
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ (out >> np.uint64(32))).view(np.int64), last


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to the n-th; those for most texts are made once."""
    size = max(1 << 12, 1 << n.bit_length())
    if size not in _POWERS:
        found = []
        for base in (_BASE, _INVERSE):
            row = np.full(size + 1, base, np.uint64)
            row[0] = 1
            found.append(np.multiply.accumulate(row))
        if size > 1 << 16:
            return tuple(found)
        _POWERS[size] = tuple(found)
    return _POWERS[size]


def without_runs(text: str, known: set[int], run: int = RUN, least_words: int = LEAST_WORDS) -> tuple[str, int, int]:
    """The text without parts in a known run or in a later copy of one of its own; how many it had and lost."""
    sizes, pieces = pieces_of(text)
    hashes, last = run_hashes(sizes, pieces, run, least_words)
    if not known and len(np.unique(hashes)) == len(hashes):
        return text, len(sizes), 0
    gone: set[int] = set()
    seen: set[int] = set()
    for at, (h, end) in enumerate(zip(hashes.tolist(), last.tolist())):
        if h in known or h in seen:
            gone.update(range(at, end + 1))
        seen.add(h)
    if not gone:
        return text, len(sizes), 0
    kept, at = [], 0
    for part, holds in parts_of(text):
        if not (holds and at in gone):
            kept.append(part)
        at += holds
    return "".join(kept), len(sizes), len(gone)


def runs_of(texts: DataFrame, run: int = RUN, least_words: int = LEAST_WORDS) -> DataFrame:
    """``hash, id``: the different runs of every row ``id, text``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(found):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["hash", "id"])

        for batch in batches:
            found, n = [], 0
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                hashes = np.unique(run_hashes(*pieces_of(text), run, least_words)[0])
                found.append((hashes, np.full(len(hashes), doc, np.int64)))
                n += len(hashes)
                if n >= ROWS_AT_ONCE:
                    yield made(found)
                    found, n = [], 0
            if found:
                yield made(found)

    return texts.mapInArrow(rows, "hash long, id long")


def remove_repeats(
    docs: DataFrame, run: int = RUN, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text, n_sentences, n_removed``: every document without its repeated parts (see ``parts_of``).

    A run (see ``run_hashes``) is repeated in every document but the one of smallest id that has it, and after its first
    place within a document. All parts of repeated runs go. Any passage of some 50 words holds whole runs, in
    whatever it stands: parts have ``LONGEST_PART`` words or are cut where the words themselves say.
    Runs are found once and stored. They are counted before the shuffle that finds the repeated ones, and these are
    joined back to all runs: a run in very many documents is a skewed partition, which adaptive execution splits. Texts
    are shuffled once, to meet the hashes of their repeated runs.

    A null or empty text has no parts and stays empty; a text of fewer than ``least_words`` words has no run and stays as it
    is. Rows without an id lose only what repeats within them. Rows that repeat an id are one document as far as
    other ids go; what they share among each other stays.
    """
    texts = id_and_text(docs, id_col, text_col)
    runs = stored(runs_of(texts.filter("id is not null"), run, least_words), "runs")
    ends = runs.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    repeated = ends.filter("first < last").select("hash", "first")
    later = runs.join(repeated, "hash").filter("id > first")
    known = later.groupBy("id").agg(F.collect_set("hash").alias("hashes"))
    met = texts.join(known.withColumnRenamed("id", "known_id"), F.col("id") == F.col("known_id"), "left").select("id", "text", "hashes")

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            without_runs(text, set(hashes or ()), run, least_words)
            for text, hashes in zip(batch.column("text").to_pylist(), batch.column("hashes").to_pylist())
        ]
        text, had, lost = zip(*found)
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(text, pa.string()), pa.array(had, pa.int64()), pa.array(lost, pa.int64())],
            ["doc_id", "text", "n_sentences", "n_removed"],
        )

    return map_texts(met, clean, "doc_id long, text string, n_sentences long, n_removed long")
