"""Text functions, pages, chunks and classes on small cases."""

import urllib.parse
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodemill.functions import chunking, pages, text
from lodemill.functions.vectors import dot, normalized
from lodemill.operators import triples
from lodemill.operators.ranking import global_rank, tile
from lodemill.plans import texts as plans

ODD = ["", "a+b c", "100%", "가/나", "~*_-.", "a&b=c#d?e", None, "é̈", "x" * 300]


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v"))).first()[0]


def test_urls(spark):
    df = spark.createDataFrame([(v,) for v in ODD], "v string")
    got = df.select(text.url_encoded(F.col("v")), text.url_decoded(text.url_encoded(F.col("v")))).collect()
    assert [r[0] for r in got] == [None if v is None else urllib.parse.quote(v, safe="") for v in ODD]
    assert [r[1] for r in got] == ODD
    assert one(spark, "a+b%20c", text.url_decoded) == "a+b c" and one(spark, "%zz", text.url_decoded) is None


def test_keys(spark):
    assert one(spark, "9:00002", text.point_key) == str(uuid.uuid5(uuid.NAMESPACE_URL, "9:00002"))
    row = spark.range(1).select(text.chunk_key(F.lit("d"), F.lit(7)), text.chunk_key(F.lit("d"), F.lit(123456)), text.shard_path(F.lit("abc")), text.shard_path(F.lit("abcdef"))).first()
    assert tuple(row) == ("d:00007", "d:123456", "0a/bc/0abc.gz", "ab/cd/abcdef.gz")


@pytest.mark.parametrize("title, parent", [("a/b/c", "a/b"), ("a", None), ("/a", None), ("a/", "a"), (" /x", None), ("a /b", "a"), (None, None), ("/", None)])
def test_parent(spark, title, parent):
    assert one(spark, title, text.parent_title) == parent


def test_plain_text(spark):
    source = "<script>x</script>A&nbsp;&lt;b&gt;\x00<p>one</p>two​ three<div>[ 편집 ]</div><details><summary>[ 펼치기 · 접기 ]</summary>box</details><a href='/edit/x'>편집</a><p>토론</p>\n\n\n\nend\t <img src=x>."
    assert one(spark, source, text.plain_text) == "A <b> one\ntwo three\n\n\nend .".replace("\n\n\n", "\n\n")
    assert one(spark, None, text.plain_text) is None and one(spark, "", text.plain_text) == ""


HEAD = "<html><h1><a>Title</a></h1><time datetime=\"2025-01-14T11:44:01.000Z\">x</time>" + "<!-- fill -->" * 40
BODY = "lead <h2><a id='s-1'>1.</a><span id='One'>One</span></h2>first<h3><a id='s-1.1'>1.1.</a> Inner </h3>second<h2><a id='s-2'>2.</a><span id='Two'>Two</span></h2>third"


def test_sections():
    rows = pages.section_rows(HEAD + BODY + "이 저작물은 free")
    assert [(r[1], r[2], r[3], r[4].split("\x1f")) for r in rows] == [
        (None, None, -1, [""]), ("s-1", "One", 1, ["One"]), ("s-1.1", "Inner", 2, ["One", "Inner"]), ("s-2", "Two", 1, ["Two"]),
    ]
    assert [r[5] for r in rows] == ["", "first", "second", "third"]
    plain = HEAD + "just text"
    assert pages.section_rows(plain)[0][5] == "<!-- fill -->" * 40 + "just text"
    assert pages.section_rows("x" * 499)[0][6] == "short" and pages.section_rows(None)[0][6] == "short"
    assert pages.section_rows("이 저작물은" + plain)[0][6] == "bounds"


def test_bounds_take_the_first_of_last_marks():
    source = "이 저작물은 a 크리에이티브 커먼즈 b 이 저작물은 c"
    assert pages.bounds(source) == (0, source.index("크리에이티브"))


def test_links_and_categories():
    source = """<a href='/w/b_c'>x</a><a href="/w/%EA%B0%80">y</a><a href='/w/a#s-1'>z</a><a href='/w/q?x=1'>q</a><a href='/w/분류:c'>c</a><a href='/w/a+b'>p</a><a href='/w/%20'>blank</a><a href='/other'>o</a>"""
    assert pages.links(source) == sorted(["b_c", "가", "a+b"]) and pages.links(None) == []
    assert pages.categories("<a href='/w/분류:b c'>c</a><a href='/w/%EB%B6%84%EB%A5%98:a'>x</a><a href='/w/분류:분류:b c'>y</a>") == ["b c", "a"]


def row(label, value):
    return f"<td><div><strong>{label}</strong></div></td> <td>{value}</td>"


def link(title):
    return f"<a class='wiki-link-internal' href='/w/x' title='{title}'>{title}</a>"


def test_facts():
    source = row("국적", "") + row("국적", link("late")) + row("직업", link("a") + link("b") + link("a")) + row("출생", "1990년 &amp; more") + row("수도", link("음력") + " text") + row("odd", link("z"))
    got = pages.facts(source)
    assert [f[:3] for f in got] == [("직업", "a", "page"), ("직업", "b", "page"), ("출생", "1990년 & more", "literal"), ("수도", "음력 text", "literal")]
    assert ("odd", "z", "page", "z") in pages.facts(source, None)
    many = "".join(row(p, link(f"{p}1") + link(f"{p}2")) for p in sorted(pages.PREDICATES))
    assert len(pages.facts(many, most=3)) == 4  # the second row is finished
    assert pages.facts(None) == [] and pages.facts("<strong>") == []


def test_split_long():
    assert chunking.split_long("x" * 850) == ["x" * 850]
    assert chunking.split_long("x" * 2000) == ["x" * 2000]
    parts = chunking.split_long("\n\n".join(["a" * 500, "b" * 500, "c" * 100]))
    assert parts == ["a" * 500, "a" * 128 + " " + "b" * 500 + "\n" + "c" * 100]


def test_pieces_merge():
    assert [p.text for p in chunking.pieces_of([("s", "", "a" * 600), ("s", "", "b" * 199), ("s", "", "c" * 200), ("t", "", "d"), (None, "", "e"), (None, "", "f"), ("t", "", " ")])] == [
        "a" * 600 + "\n" + "b" * 199, "c" * 200, "d", "e\nf",
    ]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab. \n。가", max_size=600), max_size=5))
def test_chunks_cover_their_text(parts):
    whole = "\n\n".join(parts)
    joined = "".join("".join(chunking.split_long(whole)).split())
    position = 0
    for c in "".join(whole.split()):
        position = joined.index(c, position) + 1


def test_chunk_table(spark):
    df = spark.createDataFrame([(1, "T", "== One ==\nshort\n== Two ==\nmore"), (2, "U", None), (3, None, "")], "doc_id long, title string, text string")
    got = chunking.chunk(df.select("doc_id", "title", chunking.sections(F.col("text")).alias("sections"))).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.text, r.heading_path) for r in got] == [("1:00000", "T > One\nshort", ["One"]), ("1:00001", "T > Two\nmore", ["Two"])]


CASES = [
    ("2020년", ["영화"], ["감독"], "concept"), ("x", ["대한민국의 남성 배우"], [], "person"), ("x", ["아시안 게임 개최국", "서아시아 국가"], [], "place"), ("x", ["광역자치단체"], [], "place"),
    ("경기도", ["경기도 출신 인물"], [], "concept"), ("x", ["분류:어느 인물"], [], "concept"), ("x", ["a", "b", "c", "d", "e", "f", "영화"], [], "concept"), ("당나라", ["국가"], ["사망", "수도"], "place"),
    ("x", ["전쟁", "동물"], [], "event"), ("x", None, None, "concept"), (None, ["영화"], ["본사"], "organization"), ("x", [None, "", "영화 감독"], [], "person"),
]


def test_classes(spark):
    df = spark.createDataFrame([c[:3] for c in CASES], "t string, c array<string>, p array<string>")
    assert [r[0] for r in df.select(triples.entity_class(F.col("t"), F.col("c"), F.col("p"))).collect()] == [c[3] for c in CASES]


def test_relations_once(spark):
    docs = spark.createDataFrame([("a/b", ["x", "x", "", None, "토론 y", "z 둘러보기"]), (None, None)], "title string, categories array<string>")
    redirects = spark.createDataFrame([("r", "a"), ("r", "a"), (None, "a"), ("q", None)], "alias string, canonical string")
    got = triples.build(triples.title_relations(docs), triples.category_relations(docs), triples.redirect_relations(redirects))
    assert sorted((r.subject, r.predicate, r.object) for r in got.collect()) == [("a/b", "INSTANCE_OF", "x"), ("a/b", "PART_OF", "a"), ("r", "SAME_AS", "a")]


def test_vectors(spark):
    r = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>").select(normalized(F.col("a")), normalized(F.col("z")), dot(F.col("a"), F.col("a"))).first()
    assert tuple(r) == ([0.6, 0.8], [0.0, 0.0], 25.0)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 30), max_size=40))
def test_global_rank_and_tiles(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    got = {r.id: (r["rank"], r.t) for r in global_rank(df, F.desc("v"), F.asc("id")).withColumn("t", tile(F.col("rank"), F.lit(len(values)), 4)).collect()}
    order = sorted(range(len(values)), key=lambda i: (-values[i], i))
    sizes = [len(values) // 4 + (k < len(values) % 4) for k in range(4)]
    tiles = [k + 1 for k, n in enumerate(sizes) for _ in range(n)]
    assert got == {i: (k + 1, tiles[k]) for k, i in enumerate(order)}


def test_relations_of_all_four_sources(spark):
    box = "<table><tr><td><strong>출생</strong></td><td><a href='/w/서울'>서울</a></td></tr><tr><td><strong>국적</strong></td><td>한국</td></tr></table>"
    tables = {
        "documents": spark.createDataFrame([("a/b", ["사람", "사람"]), ("c", None)], "title string, categories array<string>"),
        "redirects": spark.createDataFrame([("x", "c"), (None, "c")], "alias string, canonical string"),
        "extracted_docs": spark.createDataFrame([(1, "a/b", box), (2, "c", box), (3, "c", box), (4, "d", None)], "doc_id long, title string, link_html string"),
    }
    want = {(title, *fact[:2], fact[2], "infobox", fact[3]) for title in ("a/b", "c") for fact in pages.facts(box)}
    assert len(want) == 4
    want |= {("a/b", "PART_OF", "a", "page", "title", "a/b"), ("a/b", "INSTANCE_OF", "사람", "literal", "category", None), ("x", "SAME_AS", "c", "page", "redirect", None)}
    got = [tuple(r) for r in plans.t12(tables.__getitem__).collect()]
    assert len(got) == len(want) and set(got) == want
