import base64
import random

import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodemill.llm import tokens
from lodemill.session import tokenizer_dir

PATH = f"{tokenizer_dir()}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def whole():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("test", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


TEXTS = [None, "", " ", "Hello's world", "한국어 글 12개", "<|endoftext|>", "  \n\n  x", "a" * 300, "é 가́ 가", "tab\t \r\nend ", "🙂🙂 \x00\x1f", "don't we'll I'd"]


def test_whole_table(spark, whole):
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    got = {r.doc_id: r.ids for r in tokens.encode(df, "doc_id", "text", PATH).collect()}
    assert got == {i: whole(t) if t else [] for i, t in enumerate(TEXTS)}
    assert all(tokens.decode(got[i], PATH) == (t or "").encode() for i, t in enumerate(TEXTS))
    assert tokens.encode(df.limit(0), "doc_id", "text", PATH).count() == 0


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (50, 40), (33, 4)])
def test_stitching(spark, whole, chunk, overlap):
    chooser = random.Random(chunk)
    parts = [" ", "  ", "\n", "word", "낱말", "12", "'", "'re", "'ll", "!", "…", "a" * 90, " " * 70, "é", "🙂"]
    texts = ["".join(chooser.choice(parts) for _ in range(chooser.randint(0, 120))) for _ in range(60)] + ["x" * 500, " " * 500, "ab " * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in tokens.encode(df, "doc_id", "text", PATH, chunk=chunk, overlap=overlap).collect()}
    assert got == {i: whole(t) for i, t in enumerate(texts)}


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(max_size=60))
def test_round_trip(whole, text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    ids = tokens.Encoder(PATH).ids(text)
    assert ids == whole(text)
    assert tokens.decode(ids, PATH) == text.encode()
