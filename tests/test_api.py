"""Lookups and searches on the smallest tables."""

import pytest

from lodemill import __main__ as cli
from lodemill.api import Corpus

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    return Corpus(spark, ROOT)


@pytest.fixture(scope="module")
def title(corpus):
    return corpus.table("documents").where("size(outlinks) > 3 AND community IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").first().title


def test_cards(corpus, title):
    card = corpus.card(title, 3).collect()
    assert len(card) == 1 and len(card[0].outlinks) == 3 and card[0].outlinks == sorted(card[0].outlinks)
    linked = {r.title for r in corpus.table("documents").collect() if r.outlinks and title in r.outlinks}
    assert {r.title for r in corpus.backlinks(title, 1000).collect()} == linked
    assert corpus.card("nobody's page").count() == 0
    assert title not in {r.title for r in corpus.peers(title).collect()}
    assert {r.source for r in corpus.relations_of(title).collect()} <= {"infobox", "title", "category", "redirect"}
    assert corpus.relations_to(title, 5).count() <= 5


def test_path(corpus):
    docs = {r.title: r for r in corpus.table("documents").collect()}
    source, target = next((a, b) for a, r in docs.items() for b in r.outlinks or [] if b in docs and a != b)
    found = corpus.path(source, target, avoid_calendar=False).collect()
    assert [(r.hops, r.path) for r in found] == [(1, [source, target])]
    assert corpus.path(source, "nobody's page").count() == 0
    assert corpus.path(source, source).collect()[0].path == [source]


def test_picture(corpus, title):
    shown, inner = corpus.picture(title, 10)
    names = {r.title for r in shown.collect()}
    assert 0 < len(names) <= 10 and title not in names
    assert all(r.src in names and r.dst in names for r in inner.collect())


def test_search(corpus, title):
    hits = corpus.search(title, k=5).collect()
    assert [r["rank"] for r in hits] == list(range(1, len(hits) + 1)) and hits[0].title == title
    vector = corpus.table("embeddings").where("vec_id = 3").first().embedding
    both = corpus.search(title, vector=vector, k=8, expand=True).collect()
    assert len({r.doc_id for r in both}) == len(both) == 8
    kind = corpus.table("documents").where("entity_type IS NOT NULL").first().entity_type
    typed = {r.title for r in corpus.table("documents").where(f"entity_type = '{kind}'").collect()}
    assert all(r.title in typed for r in corpus.search(title, vector=vector, entity_type=kind).collect())
    category = corpus.table("documents").where("size(categories) > 0").first().categories[0]
    own = {r.doc_id for r in corpus.table("documents").collect() if category in (r.categories or [])}
    assert {r.doc_id for r in corpus.search("the", vector=vector, category=category).collect()} <= own
    assert corpus.search("zzzzqqq").count() == 0


def test_totals(corpus, title):
    assert corpus.communities(3).count() <= 3 and corpus.types().count() > 0 and corpus.stats().count() == 1
    assert corpus.facts([title]).count() >= 0


def test_command(spark, tmp_path):
    cli.main(["D05_group_count", "--root", ROOT, "--out", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
    assert len(cli.queries()) > 100
