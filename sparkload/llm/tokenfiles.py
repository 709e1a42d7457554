"""Token ids in binary files of patched frame-of-reference blocks, and the reader of these files.

A file holds the ids of consecutive documents::

    magic | block | block | ... | block starts u64[] | document ids i64[] | document lengths i64[] | tail

A block holds up to ``BLOCK`` ids: the smallest id (u32), the bit width (u8), the number of exceptions
(u16) and of ids (u16), the differences to the smallest id packed at that width, then positions (u16)
and full differences (u32) of the exceptions. The width is the one that ``PERCENTILE`` percent of the
differences fit into. The tail holds three counts (blocks, documents, ids), the place of the index and
the magic, so that a reader can seek to any block. All numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import begin, held, id_and_text, query_partitions, stored
from .wordbpe import ChunkEncoder

MAGIC = b"PFORIDS1"
BLOCK = 1024  # a multiple of 64
PERCENTILE = 90
FILE_BYTES = 32 << 20  # a task goes on in a new file beyond this
_HEAD = struct.Struct("<IBHH")
_TAIL = struct.Struct("<QQQQ8s")


# --- blocks -------------------------------------------------------------------------------------


def _lanes(width: int) -> Iterator[tuple[int, int, int]]:
    """For each of 64 values packed into ``width`` 64-bit words: its lane, word and offset."""
    for lane in range(64):
        yield lane, lane * width // 64, lane * width % 64


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values below ``2**width``, n x 64, as n x width words."""
    values = values.astype("<u8")
    out = np.zeros((len(values), width), "<u8")
    for lane, word, offset in _lanes(width) if width else ():
        out[:, word] |= values[:, lane] << np.uint64(offset)
        if offset + width > 64:
            out[:, word + 1] |= values[:, lane] >> np.uint64(64 - offset)
    return out


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), 64), "<u8")
    mask = np.uint64((1 << width) - 1)
    for lane, word, offset in _lanes(width) if width else ():
        out[:, lane] = words[:, word] >> np.uint64(offset)
        if offset + width > 64:
            out[:, lane] |= words[:, word + 1] << np.uint64(64 - offset)
    return out & mask


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """The blocks of an array of unsigned 32-bit ids; only the last may hold fewer than ``BLOCK``."""
    if not len(ids):
        return []
    n = -(-len(ids) // BLOCK)
    padded = np.full(n * BLOCK, ids[-1], np.uint32)
    padded[: len(ids)] = ids
    rows = padded.reshape(n, BLOCK)
    base = rows.min(axis=1)
    rows = rows - base[:, None]
    at = min(BLOCK - 1, int(BLOCK * percentile / 100))
    reach = np.partition(rows, at, axis=1)[:, at]
    widths = np.ceil(np.log2(reach.astype(np.float64) + 1)).astype(np.int64)
    counts = np.full(n, BLOCK)
    counts[-1] = len(ids) - (n - 1) * BLOCK
    out: list[bytes] = [b""] * n
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        part = rows[chosen].astype(np.uint64)
        beyond = part >> np.uint64(width) != 0
        words = pack(np.where(beyond, np.uint64(0), part).reshape(-1, 64), int(width)).reshape(len(chosen), -1)
        for k, block in enumerate(chosen):
            places = np.flatnonzero(beyond[k, : counts[block]])
            out[block] = b"".join(
                (
                    _HEAD.pack(int(base[block]), int(width), len(places), int(counts[block])),
                    words[k].tobytes(),
                    places.astype("<u2").tobytes(),
                    part[k, places].astype("<u4").tobytes(),
                )
            )
    return out


def decode_blocks(data, starts: list[int]) -> np.ndarray:
    """The ids of the blocks that begin at ``starts``; blocks of the same width are unpacked together."""
    heads = [_HEAD.unpack_from(data, s) for s in starts]
    if not heads:
        return np.zeros(0, "<u4")
    out = np.zeros((len(heads), BLOCK), "<u8")
    groups = BLOCK // 64
    of_width: dict[int, list[int]] = {}
    for k, (_, width, _, _) in enumerate(heads):
        of_width.setdefault(width, []).append(k)
    for width, blocks in of_width.items():
        words = [np.frombuffer(data, "<u8", groups * width, starts[k] + _HEAD.size) for k in blocks]
        out[blocks] = unpack(np.concatenate(words).reshape(len(blocks) * groups, width), width).reshape(len(blocks), BLOCK)
    for k, (_, width, exceptions, _) in enumerate(heads):
        at = starts[k] + _HEAD.size + 8 * groups * width
        out[k, np.frombuffer(data, "<u2", exceptions, at)] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    out += np.array([h[0] for h in heads], "<u8")[:, None]
    counts = np.array([h[3] for h in heads])
    return out[np.arange(BLOCK) < counts[:, None]].astype("<u4")


class FileBuilder:
    """One file in memory: whole blocks are encoded as soon as there are enough ids."""

    def __init__(self):
        self.parts, self.size, self.starts = [MAGIC], len(MAGIC), []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.docs: list[int] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(NO_ID if doc_id is None else doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= 256 * BLOCK:
            self._flush(self.n_waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for block in encode_blocks(ids[:n]):
            self.starts.append(self.size)
            self.parts.append(block)
            self.size += len(block)
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def data(self) -> bytes:
        self._flush(self.n_waiting)
        index = (np.array(self.starts, "<u8"), np.array(self.docs, "<i8"), np.array(self.lengths, "<i8"))
        tail = _TAIL.pack(len(self.starts), len(self.docs), self.n_ids, self.size, MAGIC)
        return b"".join((*self.parts, *(a.tobytes() for a in index), tail))


NO_ID = -(2**63)  # stands for a null document id within a file


class FileReader:
    """Random access to the ids of one file by means of its block index."""

    def __init__(self, data):
        self.data = data
        blocks, docs, self.n_ids, at, magic = _TAIL.unpack_from(data, len(data) - _TAIL.size)
        if magic != MAGIC or bytes(data[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a token file")
        self.starts = np.frombuffer(data, "<u8", blocks, at)
        self.docs = np.frombuffer(data, "<i8", docs, at + 8 * blocks)
        self.lengths = np.frombuffer(data, "<i8", docs, at + 8 * (blocks + docs))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only the blocks that hold them are decoded."""
        first, last = start // BLOCK, -(-stop // BLOCK)
        return decode_blocks(self.data, self.starts[first:last].tolist())[start - first * BLOCK : stop - first * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, start within the file and token ids of each document, decoding some blocks at a time."""
        ends = np.cumsum(self.lengths)
        window, low = np.zeros(0, "<u4"), 0
        for doc, n, end in zip(self.docs.tolist(), self.lengths.tolist(), ends.tolist()):
            begin = end - n
            if end > low + len(window):
                low = begin // BLOCK * BLOCK
                window = self.ids(low, min(self.n_ids, max(end, low + 256 * BLOCK)))
            yield (None if doc == NO_ID else doc), begin, window[begin - low : end - low]


def encoder(path: str) -> ChunkEncoder:
    return held("chunks", path, lambda: ChunkEncoder(path))


# --- files --------------------------------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """Encode every whole text, add ``end_id``, and write the ids in ascending order of document id.

    Returns the stored list of files ``part, piece, n_docs, n_ids``. Documents are dealt by ranges of the id, then
    each task encodes its range in order and writes it below ``folder``, a URI that all executors reach. A file
    appears under its name only when complete, and a repeated task writes the same files again. Null
    texts are empty: only the end id. Rows without an id come first; repeated rows are written each time.
    """
    spark = docs.sparkSession
    ordered = id_and_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    n = partitions or query_partitions(spark)
    ordered = ordered.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, encode = context.partitionId(), encoder(tokenizer_path).encode
        store, path = arrow_fs.FileSystem.from_uri(folder)
        rows: list[tuple[int, int, int, int]] = []

        def close(building: FileBuilder) -> None:
            name = f"part-{part:06d}-{len(rows):06d}.pfor"
            rows.append((part, len(rows), len(building.docs), building.n_ids))
            draft = f"{path}/_{name}.{context.taskAttemptId()}"
            store.create_dir(path, recursive=True)
            with store.open_output_stream(draft) as out:
                out.write(building.data())
            store.move(draft, f"{path}/{name}")

        building = FileBuilder()
        for batch in batches:
            for doc, ids in zip(batch.column("id").to_pylist(), encode(batch.column("text").to_pylist())):
                building.add(doc, np.frombuffer(ids + end, "<u4"))
                if building.size >= FILE_BYTES:
                    close(building)
                    building = FileBuilder()
        if building.docs:
            close(building)
        if rows:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "piece", "n_docs", "n_ids"])

    return stored(ordered.mapInArrow(run, "part long, piece long, n_docs long, n_ids long"), "token-files")


def read_token_files(spark: SparkSession, files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Every document in the listed files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids``.

    ``start`` counts the ids of all documents before this one. The list of files has a row a file; the
    running total over it is the only thing computed in one place.
    """
    schema = "part long, piece long, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    names = [f.split()[0] for f in schema.split(", ")]
    if files.isEmpty():
        empty = spark.createDataFrame([], schema)
        return empty.select("doc_id", F.col("at").alias("start"), *names[4:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("token files")
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                part, piece = map(int, path.rpartition("/")[2].removesuffix(".pfor").split("-")[1:])
                rows = []
                for doc, at, ids in FileReader(content.as_buffer()).documents():
                    row = (part, piece, doc, at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")))
                    rows.append((*row, ids.astype("<i8")) if with_ids else row)
                    if len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _columns(rows)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in _columns(rows)], names)

    def _columns(rows):
        kinds = [pa.int64()] * 6 + [pa.list_(pa.int64())] * with_ids
        return [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]

    contents = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder).select("path", "content")
    found = contents.mapInArrow(run, schema)
    before = F.sum("n_ids").over(Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1))
    begins = files.select("part", "piece", F.coalesce(before, F.lit(0)).alias("before"))
    whole = found.join(begins, ["part", "piece"])  # a row a file: the size of the list decides how
    return whole.select("doc_id", (F.col("before") + F.col("at")).alias("start"), *names[4:])
