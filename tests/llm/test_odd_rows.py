"""Very long texts, nulls in every column, and repeated rows, through every text operator."""

import pytest

from lodemill.llm.body import main_pieces
from lodemill.llm.leaks import leaks
from lodemill.llm.neardup import NearDuplicates
from lodemill.llm.repetition import profiles
from lodemill.llm.tokens import Encoder, encode
from lodemill.session import tokenizer_dir

PATH = f"{tokenizer_dir()}/byte_bpe_50k.tiktoken"
LONG = " ".join(f"word{i} 낱말{i}, again." for i in range(40_000))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, LONG, "ko"), (2, None, None), (3, "", ""), (4, "a\x00b", "xx"), (5, LONG + " end", "EN"), (6, "🙂" * 1000, "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_encode(docs):
    got = {r.doc_id: r.ids for r in encode(docs, "doc_id", "text", PATH).collect()}
    encoder = Encoder(PATH)
    assert len(LONG) > 1 << 18 and got == {r.doc_id: encoder.ids(r.text) for r in docs.collect()}


def test_leaks(spark, docs):
    items = spark.createDataFrame([(1, LONG[500_000:500_400]), (2, None), (None, "x" * 90), (3, "nowhere " * 20)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in leaks(docs, items, edits=2).collect()) == [(1, 1), (5, 1)]


def test_profiles(docs):
    got = {r.doc_id: r for r in profiles(docs).collect()}
    assert got[1].windows == 3 * 40_000 - 4 and got[1].repeated == 0 and got[2].windows == 0
    assert got[6].windows == 0 and got[4].windows == 0


def test_near_duplicates(docs):
    near = NearDuplicates(docs, "doc_id", "text")
    assert [tuple(r) for r in near.pairs().collect()] == [("1", "5")]


def test_main_body(spark):
    page = "<html><body><div><h1>T</h1>" + "".join(f"<p>Paragraph {i}, with commas, and words.</p>" for i in range(20_000)) + "</div></body></html>"
    rows = [(1, page, None), (None, page, page), (2, None, None), (3, "", " "), (1, page, None)]
    got = main_pieces(spark.createDataFrame(rows, "doc_id long, body_html string, link_html string")).collect()
    assert len(got) == 2 * 20_001 and {r.doc_id for r in got} == {1}
