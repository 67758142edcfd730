"""Retrieval queries (R, B15 to B17, E03, E04, F06, F07, F12). Questions are the rows whose id is divisible by 100."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import encoders, graph, retrieval
from ..operators.ranking import top_per_group
from ..operators.vectors import VectorIndex
from .graphs import _RESOLVED, resolved_edges
from ..session import cut, shared_dir
from .registry import Registry, Tables

query = Registry()
QUERIES, SQL = query.queries, query.sql

_LEG = 100
_TOKENS = "(SELECT id, token, count(*) AS tf FROM (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS token FROM documents WHERE text IS NOT NULL) GROUP BY ALL)"
_COSINE = "list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[])"
_DENSE = f"""SELECT q.vec_id AS qid, e.vec_id AS id, round({_COSINE}, 6) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY round({_COSINE}, 6) DESC, e.vec_id) AS rank
    FROM embeddings q JOIN embeddings e ON e.vec_id <> -1 {{0}} WHERE q.vec_id % 100 = 0"""
#: All tokens of each question's text.
_TERMS = f"""tf AS MATERIALIZED {_TOKENS}, dfs AS MATERIALIZED (SELECT token, count(*) AS df FROM tf GROUP BY token), n AS (SELECT count(DISTINCT id) AS n FROM tf),
    terms AS MATERIALIZED (SELECT tf.id AS qid, tf.token, ln(1 + (n - df + 0.5) / (df + 0.5)) AS weight FROM tf JOIN dfs USING (token), n WHERE tf.id % 100 = 0)"""
_SPARSE = "SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM (SELECT terms.qid, tf.id, round(sum(terms.weight * tf.tf), 6) AS score FROM terms JOIN tf USING (token) GROUP BY ALL)"


def vectors(t: Tables):
    return t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def questions(t: Tables):
    return vectors(t).where("id % 100 = 0").withColumnRenamed("id", "qid")


def dense(t: Tables, k: int = _LEG, **how):
    return retrieval.dense_topk(questions(t), vectors(t), k, **how)


def postings(t: Tables):
    return retrieval.tokens(t("documents"), "doc_id")


def question_terms(t: Tables):
    """qid, token, weight: all tokens of each question's text."""
    held = postings(t)
    count = held.agg(F.countDistinct("id").alias("n"))
    known = held.where("id % 100 = 0").join(retrieval.document_frequency(held), "token").crossJoin(F.broadcast(count))
    return known.select(F.col("id").alias("qid"), "token", retrieval.idf(F.col("n"), F.col("df")).alias("weight"))


def word_lists(t: Tables):
    return retrieval.word_lists(t("documents"), "doc_id")


def sparse(t: Tables, k: int = _LEG):
    return retrieval.sparse_scan(cut(question_terms(t)), word_lists(t), k)


@query("R03_dense_topk", f"SELECT qid, id, score::DOUBLE AS score, rank::BIGINT AS rank FROM ({_DENSE.format('')}) WHERE rank <= 10")
def r03(t: Tables):
    """Exact nearest vectors of each question."""
    return dense(t, 10)


@query("R03_indexed_topk")
def r03_indexed(t: Tables):
    """The same through an index of int8 codes in cells: not exact, see its test for the recall."""
    every = vectors(t)
    index = VectorIndex.build(every, f"{shared_dir(every.sparkSession)}/vectors-{uuid.uuid4().hex}")
    return index.search(questions(t), every, 10)


@query("R01_dense_encode")
def r01(t: Tables):
    """Every chunk as a vector of length 1, by the stand-in model."""
    chunks = t("chunks").select(F.xxhash64("chunk_id").alias("id"), "text")
    return encoders.encode_dense(chunks, encoders.HashedWords)


@query("R04_sparse_topk", f"WITH {_TERMS} SELECT qid, id, score::DOUBLE AS score, rank::BIGINT AS rank FROM ({_SPARSE}) WHERE rank <= 10")
def r04(t: Tables):
    """Texts with the greatest weight of a question's tokens."""
    return sparse(t, 10)


_BOTH = f"""{_TERMS}, dl AS MATERIALIZED (SELECT * FROM ({_DENSE.format('')}) WHERE rank <= {_LEG}), sl AS MATERIALIZED (SELECT * FROM ({_SPARSE}) WHERE rank <= {_LEG}),
    fused AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM (SELECT qid, id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT qid, id, rank FROM dl UNION ALL SELECT qid, id, rank FROM sl) GROUP BY ALL))"""


def fused(t: Tables, k: int = _LEG):
    return retrieval.fuse(dense(t), sparse(t), k=k)


@query("R05_hybrid_rrf", f"WITH {_BOTH} SELECT qid, id, score::DOUBLE AS score, rank::BIGINT AS rank FROM fused WHERE rank <= 10")
def r05(t: Tables):
    """Both legs fused by reciprocal ranks."""
    return fused(t, 10)


@query("E03_leg_ranks", f"WITH {_BOTH} SELECT 'dense' AS leg, qid, id, rank::BIGINT AS rank FROM dl UNION ALL SELECT 'sparse', qid, id, rank::BIGINT FROM sl")
def e03(t: Tables):
    return dense(t).select(F.lit("dense").alias("leg"), "qid", "id", "rank").unionByName(sparse(t).select(F.lit("sparse").alias("leg"), "qid", "id", "rank"))


def reranked(t: Tables, k: int):
    texts = t("documents").select(F.col("doc_id").alias("id"), "text")
    asked = t("documents").where("doc_id % 100 = 0").select(F.col("doc_id").alias("qid"), F.col("title").alias("question"))
    hits = fused(t).join(texts, "id").join(asked, "qid")
    return retrieval.rerank(hits, retrieval.overlap_score(F.col("question"), F.coalesce("text", F.lit(""))), k).select("qid", "id", "score", "rank")


_RERANKED = f"""{_BOTH}, marked AS (SELECT f.qid, f.id, list_distinct(list_filter(regexp_split_to_array(lower(q.title), '[^\\p{{L}}]+'), lambda x: x <> '')) AS w, list_distinct(list_filter(regexp_split_to_array(lower(coalesce(d.text, '')), '[^\\p{{L}}]+'), lambda x: x <> '')) AS v
      FROM fused f JOIN documents d ON d.doc_id = f.id JOIN documents q ON q.doc_id = f.qid WHERE f.rank <= {_LEG}),
    reranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM (SELECT qid, id, round(CASE WHEN len(w) > 0 THEN len(list_intersect(w, v))::DOUBLE / len(w) ELSE 0 END, 6) AS score FROM marked))"""


@query("R06_rerank", f"WITH {_RERANKED} SELECT qid, id, score::DOUBLE AS score, rank::BIGINT AS rank FROM reranked WHERE rank <= 24")
def r06(t: Tables):
    """The fused hits by the stand-in scorer, three times as many as are shown."""
    return reranked(t, 24)


@query("R07_tie_break", f"""WITH {_RERANKED} SELECT qid, id, place::BIGINT AS rank FROM (SELECT r.qid, r.id, row_number() OVER (PARTITION BY r.qid ORDER BY round_even(r.score, 2) DESC, coalesce(d.pagerank, 0) DESC, r.rank) AS place
    FROM reranked r JOIN documents d ON d.doc_id = r.id WHERE r.rank <= 24) WHERE place <= 8""")
def r07(t: Tables):
    """Equal scores, to two places, in the order of pagerank."""
    hits = reranked(t, 24).join(t("documents").select(F.col("doc_id").alias("id"), "pagerank"), "id")
    return retrieval.break_ties(hits, 8).select("qid", "id", F.col("place").alias("rank"))


@query("R09_expanded", f"""WITH {_BOTH}, e AS MATERIALIZED (SELECT DISTINCT src, dst FROM {_RESOLVED}), s AS MATERIALIZED (SELECT qid, id AS node FROM fused WHERE rank <= 10),
    o AS (SELECT s.qid, e.dst AS node, count(*) AS shared FROM s JOIN e ON e.src = s.node GROUP BY ALL),
    nb AS MATERIALIZED (SELECT qid, node FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY shared DESC, node) AS k FROM o WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.qid = o.qid AND s.node = o.node)
      AND EXISTS (SELECT 1 FROM s JOIN e ON e.dst = s.node WHERE s.qid = o.qid AND e.src = o.node)) WHERE k <= 40),
    dn AS (SELECT nb.qid, nb.node AS id, row_number() OVER (PARTITION BY nb.qid ORDER BY round({_COSINE}, 6) DESC, nb.node) AS rank FROM nb JOIN embeddings q ON q.vec_id = nb.qid JOIN embeddings e ON e.vec_id = nb.node),
    sn AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM (SELECT nb.qid, tf.id, round(sum(terms.weight * tf.tf), 6) AS score FROM nb JOIN terms ON terms.qid = nb.qid JOIN tf ON tf.id = nb.node AND tf.token = terms.token GROUP BY ALL)),
    x AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM (SELECT qid, id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT * FROM dn UNION ALL SELECT * FROM sn) GROUP BY ALL))
    SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY leg, rank, id)::BIGINT AS rank FROM (SELECT qid, id, rank, 0 AS leg FROM fused WHERE rank <= 20
      UNION ALL SELECT qid, id, rank, 1 FROM x WHERE rank <= 50 AND NOT EXISTS (SELECT 1 FROM fused f WHERE f.rank <= 20 AND f.qid = x.qid AND f.id = x.id))""")
def r09(t: Tables):
    """The first hits, then those of a second search among the mutual neighbours of the first ten alone, if not seen yet."""
    terms = cut(question_terms(t))
    first = cut(retrieval.fuse(dense(t), retrieval.sparse_scan(terms, word_lists(t), _LEG), k=20))
    near = graph.expand(resolved_edges(t), first.where("rank <= 10").select("qid", F.col("id").alias("node")), 40)
    pairs = cut(near.select("qid", F.col("node").alias("id")))
    legs = retrieval.dense_pairs(questions(t), pairs, vectors(t)), retrieval.sparse_pairs(terms, pairs, word_lists(t))
    again = retrieval.fuse(*(top_per_group(leg, ["qid"], [F.desc("score"), F.col("id")], _LEG) for leg in legs), k=50)
    return retrieval.append_unseen(first, again).select("qid", "id", F.col("place").alias("rank"))


@query("R10_filter_before", f"SELECT qid, id, score::DOUBLE AS score, rank::BIGINT AS rank FROM ({_DENSE.format('AND e.label = q.label')}) WHERE rank <= 10")
def r10_before(t: Tables):
    """Only rows of the question's own label compete."""
    return dense(t, 10, group="label")


@query("R10_filter_after", f"SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY rank)::BIGINT AS rank FROM (SELECT d.*, e.label = q.label AS same FROM ({_DENSE.format('')}) d JOIN embeddings e ON e.vec_id = d.id JOIN embeddings q ON q.vec_id = d.qid WHERE rank <= 10) WHERE same")
def r10_after(t: Tables):
    """The first ten, those of another label taken out, ranks made anew; there may be fewer."""
    hits = dense(t, 10).join(vectors(t).select("id", "label"), "id").join(questions(t).select("qid", F.col("label").alias("own")), "qid").where("label = own")
    return top_per_group(hits.withColumnRenamed("rank", "was"), ["qid"], [F.col("was")], 10).select("qid", "id", "rank")


@query("R11_self_retrieval", f"""WITH {_TERMS}, h AS (SELECT * FROM ({_SPARSE})), g AS (SELECT qid, rank FROM h WHERE id = qid)
    SELECT round(avg((rank <= 1)::INT), 6)::DOUBLE AS recall_1, round(avg((rank <= 5)::INT), 6)::DOUBLE AS recall_5, round(avg((rank <= 10)::INT), 6)::DOUBLE AS recall_10,
      round(avg(1.0::DOUBLE / rank), 6)::DOUBLE AS mrr, quantile_cont(rank, 0.5)::DOUBLE AS median_rank, count(*)::BIGINT AS questions FROM g""")
def r11(t: Tables):
    """How far up a text's tokens find it among all texts."""
    return retrieval.measures(retrieval.sparse_gold_ranks(cut(question_terms(t)), word_lists(t)))


@query("R12_response", f"""WITH {_RERANKED} SELECT r.qid, r.rank::BIGINT AS rank, d.title, round_even(r.score, 4)::DOUBLE AS score, d.last_modified::VARCHAR AS last_modified FROM reranked r JOIN documents d ON d.doc_id = r.id WHERE r.rank <= 8""")
def r12(t: Tables):
    """Hits as they are shown."""
    pages = t("documents").select(F.col("doc_id").alias("id"), "title", F.col("last_modified").cast("string").alias("last_modified"))
    return reranked(t, 8).join(pages, "id").select("qid", "rank", "title", F.bround("score", 4).alias("score"), "last_modified")


@query("D17_max_pool", f"""SELECT d.source, token, round(max(ln(1 + greatest(tf, 0))), 6)::DOUBLE AS weight FROM {_TOKENS} x JOIN documents d ON d.doc_id = x.id GROUP BY d.source, token""")
def d17(t: Tables):
    """Largest token count of each source, damped after the maximum rather than before it."""
    best = postings(t).join(t("documents").select(F.col("doc_id").alias("id"), "source"), "id").groupBy("source", "token").agg(F.max("tf").alias("m"))
    return best.select("source", "token", F.round(F.log1p(F.greatest("m", F.lit(0)).cast("double")), 6).alias("weight"))


@query("T15_search_text", "SELECT c.chunk_id, array_to_string(list_prepend(d.title, coalesce(c.heading_path, [])), ' ') AS question FROM chunks c JOIN documents d USING (doc_id)")
def t15(t: Tables):
    """Title and headings of a chunk as a question."""
    pages = t("documents").select("doc_id", "title")
    path = F.coalesce("heading_path", F.array().cast("array<string>"))
    return t("chunks").join(pages, "doc_id").select("chunk_id", F.concat_ws(" ", F.concat(F.array("title"), path)).alias("question"))
