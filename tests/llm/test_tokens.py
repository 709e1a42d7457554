import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkload.llm.tokens import TokenCounter, count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
COUNT = TokenCounter(MODEL)

CASES = [
    "", " ", "  ", "\n", "\n\n", " \n ", "a", "a ", " a", "a  b", "a   b    c", "a\nb", "a \nb", "a  \n b", "\na", "a\n",
    "\t\ta\tb", "a\r\nb", "<s>a</s>", "<0x0A>", "▁x ▁", " a", "日本語 テスト", "é é", "🙂🙂 ok", "\x00a",
    "a" * 5000, "ab " * 3000, "the " * 2 + " " * 40 + "end",
]


@pytest.mark.parametrize("text", CASES)
def test_count_equals_library(text):
    assert COUNT(text) == len(LIBRARY.encode(text, num_threads=1))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abe tion\n  ▁éü日🙂<>s."), max_size=60))
def test_count_equals_library_on_any_text(text):
    assert COUNT(text) == len(LIBRARY.encode(text, num_threads=1))


def test_rows(spark):
    rows = [(1, "the cat", "x"), (1, "the cat", "x"), (2, None, None), (None, "a", "y"), (4, "ab " * 5000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, count_tokens(docs, MODEL).collect()), key=str)
    want = [
        (i, len((t or "").encode()), (n := len(LIBRARY.encode(t or ""))), n > 4096) for i, t, _ in rows
    ]
    assert got == sorted(want, key=str)
    empty = count_tokens(docs.limit(0), MODEL)
    assert empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and empty.count() == 0
