import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkload.llm.tokenfiles import (
    BLOCK,
    ChunkEncoder,
    FileBuilder,
    FileReader,
    decode_blocks,
    encode_blocks,
    pack,
    read_token_files,
    unpack,
    write_token_files,
)
from sparkload.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
ENCODER = ChunkEncoder(PATH)
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("width", [0, 1, 7, 13, 16, 31, 32])
def test_pack_round_trip(width):
    rng = np.random.default_rng(width)
    values = rng.integers(0, 2**width, (5, 64), dtype=np.uint64)
    assert (unpack(pack(values, width), width) == values).all()


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=40),
    st.integers(1, 90),
)
def test_blocks_round_trip(values, times):
    ids = np.array(values * times, np.uint32)
    found = [decode_blocks(b, [0]) for b in encode_blocks(ids)]
    assert all(len(f) == BLOCK for f in found[:-1])
    assert (np.concatenate([*found, np.zeros(0, np.uint32)]) == ids).all()


def test_outliers_cost_exceptions_not_width():
    ids = np.arange(BLOCK, dtype=np.uint32) % 8 + 100
    ids[[3, 900]] = 4_000_000_000
    (block,) = encode_blocks(ids)
    assert len(block) == 9 + BLOCK * 3 // 8 + 2 * 6
    assert (decode_blocks(block, [0]) == ids).all()


def test_file_gives_any_range():
    rng = np.random.default_rng(1)
    docs = [(i if i % 7 else None, rng.integers(0, 50_000, int(n)).astype("<u4")) for i, n in enumerate(rng.integers(0, 9000, 120))]
    building = FileBuilder()
    for i, ids in docs:
        building.add(i, ids)
    reader = FileReader(building.data())
    everything = np.concatenate([ids for _, ids in docs])
    assert reader.n_ids == len(everything)
    for a, b in [(0, 10), (1023, 1025), (5000, 9000), (len(everything) - 3, len(everything)), (7, 7)]:
        assert (reader.ids(a, b) == everything[a:b]).all()
    for (i, want), (j, _, got) in zip(docs, reader.documents(), strict=True):
        assert i == j and (want == got).all()


CASES = [
    "İ, x İ. y", "a , b ), c. d", "x\u0301, y\u0301. z", "one, two. three.\nfour,", "x" * 70 + ", " + "y" * 70,
    "", " ", "the cat", "The CAT, sat.", "it's 12345 o'clock...", "a<|endoftext|>b <|startoftext|>", "\x1c a\x1fb", "a\tb\r\nc d",
    "é é ́x İstanbul, ΟΔΟΣ. ß", "日本語テスト。 ok", "🙂!? x", "word%%% next&&& it's,", "don't. I'll! we'Ve", "'s 's't", "a b", "ab\n\ncd",
]


@pytest.mark.parametrize("text", CASES)
def test_chunks_equal_whole_text(text):
    (got,) = ENCODER.encode([text])
    assert np.frombuffer(got, "<u4").tolist() == library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abTé \n\t'sl.,!<|>0İΣ́日"), max_size=40))
def test_chunks_equal_whole_text_on_any_text(text):
    (got,) = ENCODER.encode([text])
    assert np.frombuffer(got, "<u4").tolist() == library(text)


def test_store_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr("sparkload.llm.wordbpe.CACHE_BYTES", 900)
    encode = ChunkEncoder(PATH)
    texts = ["a b c d, e.", "e f g h a", "x y. z a b c d e f g h i j k"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode.encode(texts)] == [library(t) for t in texts]


def test_files_round_trip(spark):
    rows = [(i, " ".join(["the cat, sat"] * (i % 9)), i) for i in range(300)]
    rows += [(5, "repeated", 0), (5, "repeated", 0), (None, "no id", 1), (7000, None, 2), (6000, "word " * 30_000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(3)
    folder = scratch_dir(spark, "token-test")
    files = write_token_files(docs, PATH, folder, 2, partitions=4)
    got = [tuple(r) for r in read_token_files(spark, files, folder, with_ids=True).orderBy("start").collect()]
    assert [g[0] for g in got] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    total = 0
    texts = sorted((-1 if i is None else i, library(t or "") + [2]) for i, t, _ in rows)
    seen = sorted((-1 if i is None else i, ids) for i, _, _, _, ids in got)
    assert seen == texts
    for _, start, n, crc, ids in got:
        assert start == total and n == len(ids) and crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        total += n
    assert not [f for f in os.listdir(folder.removeprefix("file://")) if f.startswith("_")]


def test_empty_table(spark):
    folder = scratch_dir(spark, "token-test")
    files = write_token_files(spark.createDataFrame([], "doc_id long, text string"), PATH, folder, 2)
    found = read_token_files(spark, files, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and found.count() == 0
