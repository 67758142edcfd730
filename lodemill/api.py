"""Lookups and searches over a corpus folder, as DataFrames: what a service would show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import url_encoded
from .functions.values import CALENDAR_WEEK, CHROME_TITLES, PERSON_PREDICATES
from .operators import graph, retrieval
from .operators.ranking import top_per_group
from .plans import graphs, quality
from .plans.relational import edges, first_pages
from .session import table

#: Most titles of one frontier side that a path search keeps are all of them; steps it takes at most.
HOPS = 4


class Corpus:
    """A folder of corpus tables. scorer: an expression (question, text) -> score, an Arrow UDF of a model too."""

    def __init__(self, spark: SparkSession, root: str, scorer=retrieval.overlap_score) -> None:  # noqa: ANN001
        self.spark, self.root, self.scorer = spark, root, scorer

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.root, name)

    def card(self, title: str, limit: int = 20) -> DataFrame:
        """doc_id, title, categories, out_degree and the first outlinks of a page; no row for an unknown one."""
        own = self.table("documents").where(F.col("title") == title)
        links = F.array_sort(F.filter(F.coalesce("outlinks", F.array().cast("array<string>")), lambda x: x.isNotNull()))
        return own.select("doc_id", "title", "categories", F.size(links).alias("out_degree"), F.slice(links, 1, limit).alias("outlinks"), "pagerank", "entity_type", "community")

    def backlinks(self, title: str, limit: int = 20) -> DataFrame:
        """title and out_degree of pages that link to a page, those with most links first."""
        size = F.size("outlinks")
        return self.table("documents").where(F.array_contains("outlinks", title)).select("title", size.alias("out_degree")).orderBy(F.desc("out_degree"), "title").limit(limit)

    def relations_of(self, title: str, limit: int = 40) -> DataFrame:
        """predicate, object, obj_kind, source of a page: facts, parts, aliases, then the rest."""
        kind = F.when(F.col("source") == "infobox", 0).when(F.col("source") == "title", 1).when(F.col("source") == "redirect", 2).otherwise(3)
        own = self.table("relations").where(F.col("subject") == title).select("predicate", "object", "obj_kind", "source").distinct()
        return own.orderBy(kind, "predicate", "object").limit(limit)

    def relations_to(self, title: str, limit: int = 40) -> DataFrame:
        """subject, predicate, source of relations that point at a page, central subjects first."""
        into = self.table("relations").where(F.col("object") == title).select("subject", "predicate", "source").distinct()
        ranked = into.join(self.table("documents").select(F.col("title").alias("subject"), "pagerank"), "subject", "left")
        return ranked.orderBy(F.desc_nulls_last("pagerank"), "subject", "predicate", "source").limit(limit).drop("pagerank")

    def peers(self, title: str, limit: int = 8) -> DataFrame:
        """Titles of a page's community by pagerank; none if it has no community."""
        docs = self.table("documents")
        own = docs.where((F.col("title") == title) & F.col("community").isNotNull()).select("community")
        return docs.join(own, "community", "left_semi").where(F.col("title") != title).orderBy(F.desc_nulls_last("pagerank"), "title").limit(limit).select("title", "pagerank")

    def path(self, source: str, target: str, max_hops: int = HOPS, avoid_calendar: bool = True) -> DataFrame:
        """hops and path (titles) of a shortest undirected path; no row without one or for unknown pages."""
        pairs = graphs.topic_pairs(self.table) if avoid_calendar else graph.undirected(graphs.resolved_edges(self.table))
        ids = self.table("documents").select("doc_id", "title")
        a, b = (ids.where(F.col("title") == t).select(F.col("doc_id").alias(n), F.lit(1).alias("one")) for t, n in ((source, "source"), (target, "target")))
        found = graph.paths(pairs, a.join(b, "one").select("source", "target"), max_hops)
        steps = found.select("source", "target", "hops", F.posexplode("path").alias("pos", "doc_id")).join(ids, "doc_id")
        return steps.groupBy("source", "target", "hops").agg(F.array_sort(F.collect_list(F.struct("pos", "title"))).alias("p")).select("hops", F.transform("p", lambda x: x.title).alias("path"))

    def picture(self, title: str, limit: int = 24, hide_calendar: bool = True) -> tuple[DataFrame, DataFrame]:
        """Pages to draw around a page (title, to_near, from_near, mutual, community) and the links among them."""
        docs = self.table("documents")
        own = docs.where(F.col("title") == title).select("title", "community")
        e = edges(self.table).select("src", "dst").distinct()
        to = e.where(F.col("src") == title).select(F.col("dst").alias("near"), F.lit(True).alias("o"))
        fro = e.where(F.col("dst") == title).select(F.col("src").alias("near"), F.lit(False).alias("o"))
        near = to.unionByName(fro).where((F.col("near") != title) & ~F.col("near").isin(*CHROME_TITLES))
        if hide_calendar:
            near = near.where(~F.col("near").rlike(CALENDAR_WEEK))
        flags = near.groupBy("near").agg(F.bool_or("o").alias("to_near"), F.bool_or(~F.col("o")).alias("from_near"))
        pages = docs.select(F.col("title").alias("near"), "community", "pagerank", F.lit(1).alias("one"))
        home = own.select(F.col("community").alias("home"), F.lit(1).alias("one"))
        order = [F.col("community").eqNullSafe(F.col("home")).desc(), F.desc_nulls_last("pagerank"), F.col("near")]
        shown = flags.join(pages, "near").join(F.broadcast(home), "one").orderBy(*order).limit(limit)
        shown = shown.select("near", "to_near", "from_near", (F.col("to_near") & F.col("from_near")).alias("mutual"), "community")
        inner = e.where("src <> dst").join(shown, F.col("src") == F.col("near"), "left_semi").join(shown, F.col("dst") == F.col("near"), "left_semi")
        facts = self.table("relations").where("source = 'infobox' AND obj_kind = 'page'").groupBy(F.col("subject").alias("src"), F.col("object").alias("dst"))
        return shown.withColumnRenamed("near", "title"), inner.join(facts.agg(F.min("predicate").alias("label")), ["src", "dst"], "left")

    def communities(self, limit: int = 30) -> DataFrame:
        return first_pages(self.table, "community", 6).orderBy(F.desc("size"), "community").limit(limit)

    def types(self) -> DataFrame:
        return first_pages(self.table, "entity_type", 8)

    def stats(self) -> DataFrame:
        return quality.numbers(self.table)

    def facts(self, titles: list[str], limit: int = 24) -> DataFrame:
        """Facts of pages, without those that only persons can have on pages that are none."""
        docs = self.table("documents").select(F.col("title").alias("subject"), "pagerank", "entity_type")
        rel = self.table("relations").where(F.col("subject").isin(*titles) & (F.col("source") == "infobox")).select("subject", "predicate", "object").distinct()
        wrong = F.col("predicate").isin(*PERSON_PREDICATES) & (F.coalesce("entity_type", F.lit("")) != "person")
        return rel.join(docs, "subject", "left").where(~wrong).orderBy(F.desc_nulls_last("pagerank"), "predicate", "subject", "object").limit(limit).select("subject", "predicate", "object")

    def search(
        self, question: str, vector: list[float] | None = None, k: int = 8, candidates: int = 100, category: str | None = None, entity_type: str | None = None, expand: bool = False
    ) -> DataFrame:
        """rank, score, doc_id, title, url, last_modified of the best documents.

        Words and, if there is one, the vector each give candidates, fused by reciprocal ranks. A category
        limits what competes; an entity type is filtered last, so fewer than k may come. expand adds mutual
        neighbours of the first ten. Scores equal to two places are ordered by pagerank.
        """
        docs = self.table("documents")
        allowed: Column = F.array_contains("categories", category) if category else F.lit(True)
        pool = docs.where(allowed).select("doc_id", "text")
        held = retrieval.tokens(pool, "doc_id")
        count = held.agg(F.countDistinct("id").alias("n"), F.lit(1).alias("one"))
        asked = self.spark.createDataFrame([(0, question)], "id long, text string")
        terms = retrieval.tokens(asked).select(F.col("id").alias("qid"), "token", F.lit(1).alias("one"))
        known = terms.join(retrieval.document_frequency(held.join(terms.select("token"), "token", "left_semi")), "token").join(F.broadcast(count), "one")
        weights = known.select("qid", "token", retrieval.idf(F.col("n"), F.col("df")).alias("weight"))
        legs = [retrieval.sparse_topk(weights, held.select("id", "token", F.col("tf").alias("weight")), candidates)]
        if vector is not None:
            corpus = self.table("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")).join(pool.select(F.col("doc_id").alias("id")), "id", "left_semi")
            legs.append(retrieval.dense_topk(self.spark.createDataFrame([(0, vector)], "qid long, vector array<double>"), corpus, candidates))
        hits = retrieval.fuse(*legs, k=candidates).select("qid", "id", "rank")
        if expand:
            near = graph.expand(graphs.resolved_edges(self.table), hits.where("rank <= 10").select("qid", F.col("id").alias("node")), 40)
            allowed_ids = pool.select(F.col("doc_id").alias("id"))
            extra = near.select("qid", F.col("node").alias("id"), "rank").join(allowed_ids, "id", "left_semi").where(F.col("rank") <= max(candidates // 2, 20))
            hits = retrieval.append_unseen(hits, extra).select("qid", "id", F.col("place").alias("rank"))
        scored = hits.join(docs.select(F.col("doc_id").alias("id"), "text"), "id").withColumn("question", F.lit(question))
        best = retrieval.rerank(scored, self.scorer(F.col("question"), F.coalesce("text", F.lit(""))), 3 * k).select("qid", "id", "score", "rank")
        meta = docs.select(F.col("doc_id").alias("id"), "title", "pagerank", "last_modified", "entity_type")
        shown = retrieval.break_ties(best.join(meta, "id"), k)
        if entity_type:
            shown = shown.where(F.col("entity_type") == entity_type)
        shown = top_per_group(shown.drop("rank"), ["qid"], [F.col("place")], k)
        return shown.select("rank", F.bround("score", 4).alias("score"), F.col("id").alias("doc_id"), "title", F.concat(F.lit("/w/"), url_encoded(F.col("title"))).alias("url"), "last_modified")
