from lodemill.llm import body

PAGE = """<html><head><title>T</title><style>p{}</style><script>var x='</p><p>no';</script></head><body><!-- c <p>gone</p> -->
<ul class='m'><li><a href='/1'>Home</a></li><li><a href='/2'>Recent</a></li></ul>
<DIV class=q><H1><a href='/w/x'>Title &amp; more</a></H1>
<div class='t'><li><a href='/e'>Edit</a></li><li>History</li></div>
<div>Last edited: <time datetime="2026-01-01">2026-01-01</time></div>
<div class=toc><div><a href='#s-1'>1.</a> One</div></div>
<table><tr><td><strong>Label</strong><td>Value</table>
<h2><a id='s-1' href='#toc'>1.</a> <span id='One'>One</span> [<a href='/edit'>edit</a>]</h2>
<p>First, a paragraph&nbsp;with <b>bo</b>ld, commas, and   words.
<p>Second paragraph<br/>after a break.</p>
<ul><li>An entry<li><a href='/w/y'>A link</a></ul>
<blockquote>Quoted</blockquote>
<details><summary>open</summary><td>boxed</td></details>
<div class=c><p>We use cookies, really, and so on, and more.</p><button>Accept</button></div>
</DIV>
<div class=s><h3>Recommended</h3><p>Some prose, that reads like an article, with commas, and is long, long, long.</p></div>
<div>Categories: A | B</div><footer><li>Terms</li></footer></body></html>"""


def texts(source, kept=True):
    pieces, _ = body.parse(source)
    numbers = set(body.main_body(source))
    return [p.text for k, p in enumerate(pieces) if (k in numbers) == kept]


def test_page():
    assert texts(PAGE) == [
        "Title & more", "Label", "Value", "1. One [edit]", "First, a paragraph with bold, commas, and words.", "Second paragraph", "after a break.",
        "An entry", "A link", "Quoted",
    ]
    assert "no" not in "".join(texts(PAGE, False)) and "gone" not in texts(PAGE, False)


def test_part_of_a_page():
    part = PAGE[PAGE.index("<h2>") :]
    assert texts(part) == texts(PAGE)[3:]


def test_odd_sources():
    for source in (None, "", "   ", "<", "<p", "plain text, only", "<!-- open", "<script>never closed", "</div></div>x</p>", "<p>" * 3000 + "x", "<div>" * 3000 + "x, y" + "</div>" * 4000, "a < b & c > d"):
        assert isinstance(body.main_body(source), list)
    assert texts("plain text, only") == ["plain text, only"]
    assert [p.text for p in body.parse("a<span>b</span> c<hr>d<nav>e</nav>")[0]] == ["ab c", "d", "e"]


def test_furniture_and_table(spark):
    pages = [(i, PAGE.replace("Second paragraph", f"Paragraph {i}").replace("Quoted", f"Q{i}").replace("</DIV>", f"<p>Words of {i}, only.</p><p>Share it</p><p>End {i}.</p></DIV>"), None, "x") for i in range(12)]
    pages += [(100 + i, PAGE, "", "x") for i in range(12)]  # copies of one page
    df = spark.createDataFrame(pages, "doc_id long, body_html string, link_html string, piece_no string")
    assert [r.text for r in body.furniture_texts(df, ["body_html", "link_html"]).collect()] == ["Share it"]
    got = body.main_pieces(df).collect()
    assert {r.field_name for r in got} == {"body_html"}
    assert all("Share it" not in [body.parse(PAGE)[0][r.piece_no].text] for r in got if r.doc_id == 100)
    assert sum(r.doc_id == 3 for r in got) == 12 and sum(r.doc_id == 100 for r in got) == 10
    assert body.main_pieces(df.limit(0)).count() == 0


def test_furniture_goes_by_the_share_of_the_source(spark):
    page = "<div><p>Begin {0}, and more.</p><p>{1}</p><p>End {0}, and more.</p></div>"
    small = [(i, "a", page.format(i, "Join today")) for i in range(7)]
    genuine = [(1000 + i, "b", page.format(1000 + i, "It is a village." if i < 8 else f"Own {i}.")) for i in range(1000)]
    other = [(10_000 + i, "c", "<p>x</p>") for i in range(36_000)]
    few = [(100_000 + i, f"s{i}", page.format(100_000 + i, "It is a village.")) for i in range(9)]
    schema = "doc_id long, source string, body_html string"
    for pages in (small + genuine, small + genuine + few + other):  # the same, however many other pages there are
        df = spark.createDataFrame(pages, schema)
        assert [tuple(r) for r in body.furniture_texts(df, ["body_html"], "source").collect()] == [("a", "Join today")]
        got = body.main_pieces(df, fields=("body_html",), site="source").where("piece_no = 1 AND (doc_id < 10000 OR doc_id >= 100000)")
        assert {r.doc_id for r in got.collect()} == {p[0] for p in pages if p[1] not in "ac"}
