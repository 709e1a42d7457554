"""Token counts by byte-pair merging, without emitting token ids."""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, id_and_text, map_texts

SPACE = "▁"  # how the vocabulary writes a space
CACHED_SEGMENTS = 300_000
CACHED_LENGTH = 64  # characters; longer segments are counted anew each time


class MergeVocabulary:
    """Pieces of a byte-fallback BPE model, and the ranks of those that a merge makes: the better the score, the lower."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        score: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i)):
                score[model.id_to_piece(i)] = model.get_score(i)
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in score.items() if len(p) > 1}
        self.single = {p for p in score if len(p) == 1}
        # A segment can end where no piece spans the boundary: before a space that follows another
        # character, and around a newline, if the vocabulary agrees.
        self.splits_at_space = not any(SPACE in p.lstrip(SPACE) for p in self.rank)
        self.newline_alone = self.splits_at_space and not any("\n" in p for p in self.rank)

    def count(self, segment: str) -> int:
        """Tokens of one segment: its symbols less the merges made, in order of rank, then of position.

        The symbols are a doubly linked list over positions. The heap holds adjacent pairs as one number
        each, rank before position; an entry whose pair has changed since it was pushed is skipped. A character without
        a piece counts as its UTF-8 bytes.
        """
        n = len(segment)
        rank = self.rank.get
        symbol = list(segment)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r * n + i for i in range(n - 1) if (r := rank(segment[i : i + 2])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            r, left = divmod(heappop(heap), n)
            right = after[left]
            if right == n or not symbol[left]:
                continue
            pair = symbol[left] + symbol[right]
            if rank(pair) != r:
                continue
            merges += 1
            symbol[left], symbol[right] = pair, ""
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                r = rank(pair + symbol[following])
                if r is not None:
                    heappush(heap, r * n + left)
            previous = before[left]
            if previous >= 0:
                r = rank(symbol[previous] + pair)
                if r is not None:
                    heappush(heap, r * n + previous)
        if segment.isascii():
            return n - merges
        return n - merges + sum(len(s.encode()) - 1 for s in symbol if len(s) == 1 and s not in self.single)


class _Counts(dict):
    """Token counts of segments seen before, in two generations: the older is dropped when the newer is full."""

    def __init__(self, count):
        super().__init__()
        self.count = count
        self.older: dict[str, int] = {}

    def __missing__(self, segment: str) -> int:
        if len(segment) > CACHED_LENGTH:
            return self.count(segment)
        if len(self) >= CACHED_SEGMENTS:
            self.older = dict(self)
            self.clear()
        n = self.older.get(segment)
        if n is None:
            n = self.count(segment)
        self[segment] = n
        return n


class TokenCounter:
    def __init__(self, model_path: str):
        self.vocabulary = vocabulary = MergeVocabulary(model_path)
        newline = vocabulary.count("\n")

        def word(chunk: str) -> int:
            """A chunk between spaces; one that starts with a newline has no space before its first word."""
            if chunk.startswith("\n"):
                return newline + (vocabulary.count(chunk[1:]) if len(chunk) > 1 else 0)
            return vocabulary.count(SPACE + chunk)

        self.words = _Counts(word)
        self.segments = _Counts(vocabulary.count)

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if SPACE in text:  # written like a space in the vocabulary, and taken as one
            text = text.replace(SPACE, " ")
        if self.vocabulary.newline_alone:
            chunks = text.replace("\n", " \n").split(" ")
            if "" not in chunks:
                words = self.words
                return sum([words[c] for c in chunks])
            parts = re.findall(r"\n| *[^ \n]+| +", " " + text)
        elif self.vocabulary.splits_at_space:
            parts = re.findall(r" *[^ ]+| +", " " + text)
        else:
            parts = [" " + text]
        segments = self.segments
        return sum([segments[p.replace(" ", SPACE)] for p in parts])


def counter(model_path: str) -> TokenCounter:
    """One counter a Python worker, with what it has counted so far."""
    return held("counts", model_path, lambda: TokenCounter(model_path))


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, one pass over the texts and no shuffle.

    ``model_path`` names a byte-fallback BPE model that exists on every executor. Special strings
    within a text are ordinary text. A null or empty text has no bytes and no tokens; repeated rows and
    rows without an id give a row each.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        count = counter(model_path)
        n = pa.array([count(t) for t in batch.column("text").to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    texts = id_and_text(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = map_texts(texts, run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
