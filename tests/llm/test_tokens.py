import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterforge.llm import tokens as t

pytestmark = pytest.mark.skipif(not os.path.exists(os.path.join(t.TOKENIZER_DIR, "byte_bpe_50k.tiktoken")), reason="no vocabulary files")


@pytest.fixture(scope="module")
def encoder():
    return t.Encoder(t.read_ranks())


@pytest.fixture(scope="module")
def library():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=t.PATTERN, mergeable_ranks=t.read_ranks(), special_tokens={})


def test_like_the_library(encoder, library):
    random.seed(4)
    texts = ["a" * 5000, "ab" * 2000, "啊" * 2000, "<|endoftext|> hi", "don't  stop\n\n x", " ", "长期关注海流模拟", "".join(chr(random.randrange(1, 0x3000)) for _ in range(2000))]
    for text in texts:
        assert encoder.encode(text) == library.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab c'sé啊\n1", max_size=60))
def test_any_text(text):
    encoder = _cached()
    ids = encoder.encode(text)
    assert b"".join(encoder.tokens[i] for i in ids).decode() == text


_ENCODER = []


def _cached():
    if not _ENCODER:
        _ENCODER.append(t.Encoder(t.read_ranks()))
    return _ENCODER[0]


def test_queue_order_and_reuse():
    q = t.RankQueue()
    for rank, at in ((70, 5), (3, 9), (70, 1), (64, 2)):
        q.push(rank, at)
    assert [q.pop(), q.pop(), q.pop(), q.pop()] == [(3, [9]), (64, [2]), (70, [1, 5]), None]


def test_frame(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "hello world", "x")], "doc_id long, text string, ids string")
    got = {r["id"]: r["ids"] for r in t.encode_column(df, "doc_id", "text").collect()}
    assert got == {1: [], 2: [], 3: [31373, 995]}
    assert {r["id"]: r["n_tokens"] for r in t.count_column(df, "doc_id", "text").collect()} == {1: 0, 2: 0, 3: 2}
