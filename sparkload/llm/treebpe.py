"""Byte-pair encoding by tree concatenation, and decoding.

A text is one stream of symbols (see ``wordbpe``). It is cut into halves, and these again, down to leaves, wherever
the cuts fall: within words, and within long runs that the tokenizer does not split. Leaves are encoded on their
own, very long texts by many tasks. Two neighbours are joined by encoding the symbols of some tokens on both sides
of the join anew, more of them each time, until the first and the last token of this window come out as they
were on either side (or the window has reached that side's end).

Then the joined ids are exactly those of the whole: a sequence of tokens is the encoding of its symbols if and only if each
two neighbours are, taken alone. Merges are made in order of rank, then of place, so the first merge across any
border would be made for the two tokens beside it alone as well. Within the window, neighbours are from one
encoding; at its edges, as on either side, they are neighbours of an encoding made before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, id_and_text, query_partitions, stored
from .wordbpe import ChunkEncoder

LEAF_CHARS = 4_096  # a longer text is cut into halves
PIECE_CHARS = 1 << 18  # of a longer text, pieces of this size are encoded by tasks of their own
FIRST_WINDOW = 2  # tokens on either side of a join that are encoded anew at first


class TreeEncoder:
    """Leaves, joins and digests for one tokenizer file."""

    def __init__(self, path: str):
        self.chunks = ChunkEncoder(path)
        self.vocabulary = self.chunks.vocabulary

    def cut(self, text: str, size: int) -> list[tuple[str, str, str]]:
        """Leaves ``(tail, text, head)`` of halves of halves of a text, none much above ``size`` characters.

        A cut parts the stream of the chunk that it falls into: the end of the chunk's symbols is the ``tail`` that
        the right leaf begins with, their beginning the ``head`` that the left one ends with. Between them
        lies text of whole chunks.
        """
        if len(text) <= size:
            return [("", text, "")]
        n = 1 << (-(-len(text) // size) - 1).bit_length()
        cuts = [len(text) * k // n for k in range(1, n)]
        leaves, begin, tail, k = [], 0, "", 0
        while k < len(cuts):
            low = 1 + max(text.rfind(" ", begin, cuts[k]), text.rfind("\n", begin, cuts[k]))
            low = max(low, begin)  # the chunk that the cut falls into begins here, and ends at the next space
            ends = [e for e in (text.find(" ", cuts[k]), text.find("\n", cuts[k])) if e >= 0]
            high = min(ends, default=len(text))
            inside = [c for c in cuts[k:] if c < high] or cuts[k : k + 1]
            stream = self.vocabulary.stream(text[low:high])
            places = []
            for c in inside:
                at = len(stream) * (c - low) // max(1, high - low)
                places.append(at + (stream[at : at + 1] == " "))  # an end belongs to the symbol before it
            leaves.append((tail, text[begin:low], stream[: places[0]]))
            for a, b in zip(places, places[1:]):
                leaves.append(("", "", stream[a:b]))
            tail, begin, k = stream[places[-1] :], high, k + len(inside)
        return [*leaves, (tail, text[begin:], "")]

    def leaf_ids(self, leaves: list[tuple[str, str, str]]) -> list[np.ndarray]:
        merge, found = self.vocabulary.merge, self.chunks.encode([text for _, text, _ in leaves])
        out = []
        for (tail, _, head), ids in zip(leaves, found):
            # A tail ends where its chunk does, a head begins there: nothing merges with the text between.
            before, after = merge(tail) if tail else (), merge(head) if head else ()
            parts = (np.array(before, "<u4"), np.frombuffer(ids, "<u4"), np.array(after, "<u4"))
            out.append(np.concatenate(parts) if before or after else parts[1])
        return out

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of two neighbouring streams, given those of each."""
        symbols, n = self.vocabulary.symbols, FIRST_WINDOW
        if not len(left) or not len(right):
            return left if len(left) else right
        while True:
            a, b = left[-n:].tolist(), right[:n].tolist()
            again = self.vocabulary.merge("".join([symbols[i] for i in a + b]))
            fits_left = n >= len(left) or again[0] == a[0]
            fits_right = n >= len(right) or again[-1] == b[-1]
            if fits_left and fits_right:
                return np.concatenate((left[: max(0, len(left) - n)], np.array(again, "<u4"), right[n:]))
            n *= 2

    def tree(self, parts: list[np.ndarray]) -> np.ndarray:
        while len(parts) > 1:
            pairs = [self.join(parts[k], parts[k + 1]) for k in range(0, len(parts) - 1, 2)]
            parts = pairs + parts[len(pairs) * 2 :]
        return parts[0] if parts else np.zeros(0, "<u4")

    def encode(self, texts: list[str], size: int = LEAF_CHARS) -> Iterator[np.ndarray]:
        """Ids of each whole text."""
        leaves = [self.cut(t, size) for t in texts]
        ids = iter(self.leaf_ids([leaf for of_text in leaves for leaf in of_text]))
        for of_text in leaves:
            yield self.tree([next(ids) for _ in of_text])

    def encode_piece(self, tail: str, text: str, head: str, size: int = LEAF_CHARS) -> np.ndarray:
        """Ids of a piece of a longer text: its own text, and the cuts of streams at either end."""

        def halves(stream: str) -> list[tuple[str, str, str]]:
            out, begin = [], 0
            while begin < len(stream):
                end = begin + size
                end += stream[end : end + 1] == " "
                out.append(("", "", stream[begin:end]))
                begin = end
            return out

        return self.tree(self.leaf_ids([*halves(tail), *self.cut(text, size), *halves(head)]))

    def decode(self, ids: np.ndarray) -> str:
        """What the tokenizer, which has no decoder, gives for ids: its tokens with spaces between them."""
        token = self.vocabulary.token
        return " ".join([token[i] for i in ids.tolist()])

    def digests(self, ids: np.ndarray) -> tuple[int, str, str]:
        written = " ".join(map(str, ids.tolist()))
        return len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest()


def encoder(path: str) -> TreeEncoder:
    return held("tree", path, lambda: TreeEncoder(path))


_PIECES = "key long, place long, id long, tail string, text string, head string, n_tokens long, ids_sha256 string, decoded_sha256 string"
_NAMES = [c.split()[0] for c in _PIECES.split(", ")]
_ROWS_AT_ONCE = 256


def _encode_or_cut(texts: DataFrame, path: str, leaf: int, piece: int) -> DataFrame:
    """A row for each text that one task encodes, with its digests, and rows of pieces for each longer one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, key = encoder(path), TaskContext.get().partitionId() << 33
        schema = pa.schema([(n, pa.int64() if n in ("key", "place", "id", "n_tokens") else pa.string()) for n in _NAMES])
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(k, _ROWS_AT_ONCE)
                ids, found = part.column("id").to_pylist(), part.column("text").to_pylist()
                short = [i for i, t in enumerate(found) if len(t) <= piece]
                rows = []
                for i, encoded in zip(short, tree.encode([found[i] for i in short], leaf)):
                    rows.append((key, None, ids[i], None, None, None, *tree.digests(encoded)))
                    key += 1
                for i, text in enumerate(found):
                    if len(text) > piece:
                        rows += [(key, place, ids[i], *cut, None, None, None) for place, cut in enumerate(tree.cut(text, piece))]
                        key += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return texts.mapInArrow(run, _PIECES)


def _joined(pieces: DataFrame, path: str, leaf: int) -> DataFrame:
    """``key, id, ids`` of long texts: pieces encoded where they lie, then pairs of neighbours joined, level by level."""
    n = query_partitions(pieces.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = zip(*[batch.column(c).to_pylist() for c in ("tail", "text", "head")])
            ids = [encoder(path).encode_piece(*cut, leaf).tobytes() for cut in cuts]
            columns = [batch.column("key"), batch.column("place"), batch.column("id"), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "place", "id", "ids"])

    def join(pair: pa.Table) -> pa.Table:
        pair = pair.sort_by("place")
        ids = encoder(path).tree([np.frombuffer(x, "<u4") for x in pair.column("ids").to_pylist()])
        half = pa.array([pair.column("half")[0].as_py()], pa.int64())
        made = [pair.column("key").slice(0, 1), half, pair.column("id").slice(0, 1), pa.array([ids.tobytes()], pa.binary())]
        return pa.table(made, ["key", "place", "id", "ids"])

    schema = "key long, place long, id long, ids binary"
    last = pieces.agg(F.max("place")).first()[0]
    found = pieces.repartition(n, "key", "place").mapInArrow(encode, schema)
    while last:
        found = stored(found.withColumn("half", F.shiftright("place", 1)).groupBy("key", "half").applyInArrow(join, schema), "tree")
        last >>= 1
    return found


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF_CHARS, piece: int = PIECE_CHARS
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row: digests of a whole text's ids and of their decoding.

    Texts up to ``piece`` characters are encoded by the task that reads them, as trees of leaves of ``leaf``
    characters, without a shuffle. Pieces of longer ones are stored and dealt to tasks; a level of the tree then
    joins pairs of neighbours, so a task never holds more than two of them. Only an id that is digested at last is
    whole in one place, as a row of a text is.

    Null and empty texts have no tokens, and the digests of an empty string; repeated rows and rows without an id
    give a row each; special tokens written out in a text are taken for them, as the tokenizer does by default.
    """
    made = stored(_encode_or_cut(id_and_text(docs, id_col, text_col), path, leaf, piece), "encoded")
    names = ["id", *_NAMES[-3:]]
    done, pieces = made.filter("place is null").select(*names), made.filter("place is not null")
    if not pieces.isEmpty():

        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [encoder(path).digests(np.frombuffer(x, "<u4")) for x in batch.column("ids").to_pylist()]
                n, ids, decoded = zip(*rows) if rows else ((), (), ())
                columns = [batch.column("id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

        schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        done = done.unionByName(_joined(pieces, path, leaf).select("id", "ids").mapInArrow(digest, schema))
    return done.withColumnRenamed("id", "doc_id")
