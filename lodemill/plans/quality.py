"""The report on the corpus (V): one row a check, each table read once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import CHROME_TITLES
from .registry import Registry, Tables

query = Registry()
QUERIES, SQL = query.queries, query.sql

_CHROME = "', '".join(CHROME_TITLES)
#: check, condition over the numbers, number that is shown.
CHECKS = (
    ("V01_fetched", "fetched > 0", "fetched"), ("V02_documents", "documents > 0", "documents"), ("V03_chunks", "chunks > 0", "chunks"), ("V04_edges", "edges > 0", "edges"),
    ("V05_categories", "categorised > 0", "categorised"), ("V06_facts", "facts > 0", "facts"), ("V07_facts_linked", "linked * 10 >= facts * 7", "linked"),
    ("V08_no_chrome_rank", "chrome_ranked = 0", "chrome_ranked"), ("V09_typed", "typed > 0", "typed"), ("V10_known_types", "odd_types = 0", "odd_types"), ("V11_communities", "communities > 0", "communities"),
    ("V12_no_repeated_chunks", "repeated_chunks = 0", "repeated_chunks"), ("V13_no_orphan_chunks", "orphan_chunks = 0", "orphan_chunks"), ("V14_no_chunkless", "chunkless = 0", "chunkless"),
    ("V15_baselines", "baselines > 0", "baselines"), ("V16_no_alert", "alerts = 0", "alerts"), ("V17_vectors", "vectors > 0", "vectors"), ("V18_embedded", "embedded > 0", "embedded"), ("V19_index", "vectors > 0", "vectors"),
    ("V20_index_size", "abs(vectors - embedded) * 50 <= embedded", "vectors"),
)
TYPES = ("person", "place", "organization", "work", "event", "creature", "concept")

_NUMBERS = f"""SELECT (SELECT count(*) FROM crawl_state WHERE last_fetched IS NOT NULL) AS fetched, (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM chunks) AS chunks,
    (SELECT coalesce(sum(len(outlinks)), 0) FROM documents)::BIGINT AS edges, (SELECT count(*) FROM documents WHERE len(categories) > 0) AS categorised,
    (SELECT count(*) FROM relations WHERE source = 'infobox') AS facts, (SELECT count(*) FROM relations WHERE source = 'infobox' AND obj_kind = 'page') AS linked,
    (SELECT count(*) FROM documents WHERE title IN ('{_CHROME}') AND pagerank IS NOT NULL) AS chrome_ranked, (SELECT count(*) FROM documents WHERE entity_type IS NOT NULL) AS typed,
    (SELECT count(*) FROM documents WHERE entity_type IS NOT NULL AND entity_type NOT IN ('{"', '".join(TYPES)}')) AS odd_types, (SELECT count(DISTINCT community) FROM documents) AS communities,
    (SELECT count(*) FROM (SELECT doc_id, seq FROM chunks GROUP BY ALL HAVING count(*) > 1)) AS repeated_chunks, (SELECT count(*) FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = c.doc_id)) AS orphan_chunks,
    (SELECT count(*) FROM documents d WHERE n_chars > 0 AND NOT EXISTS (SELECT 1 FROM chunks c WHERE c.doc_id = d.doc_id)) AS chunkless,
    (SELECT count(*) FROM seed_titles s JOIN documents d ON d.title = s.title WHERE d.n_chars > 0) AS baselines, (SELECT count(*) FROM seed_titles s JOIN documents d ON d.title = s.title WHERE coalesce(d.n_chars, 0) = 0) AS alerts,
    (SELECT count(*) FROM embeddings) AS vectors, (SELECT count(*) FROM chunks WHERE embedded_at IS NOT NULL) AS embedded"""


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def numbers(t: Tables) -> DataFrame:
    """One row with every number of the report."""
    docs, chunks, rel = t("documents"), t("chunks"), t("relations")
    infobox = F.col("source") == "infobox"
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).otherwise(0)
    seeds = t("seed_titles").select("title").join(docs.select("title", "n_chars"), "title")
    parts = [
        docs.agg(
            F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(size("outlinks")), F.lit(0)).alias("edges"), F.count_if(size("categories") > 0).alias("categorised"),
            F.count_if(F.col("title").isin(*CHROME_TITLES) & F.col("pagerank").isNotNull()).alias("chrome_ranked"), F.count("entity_type").alias("typed"),
            F.count_if(F.col("entity_type").isNotNull() & ~F.col("entity_type").isin(*TYPES)).alias("odd_types"), F.countDistinct("community").alias("communities"),
        ),
        chunks.agg(F.count(F.lit(1)).alias("chunks"), F.count("embedded_at").alias("embedded")),
        rel.agg(F.count_if(infobox).alias("facts"), F.count_if(infobox & (F.col("obj_kind") == "page")).alias("linked")),
        t("crawl_state").agg(F.count("last_fetched").alias("fetched")),
        _count(chunks.groupBy("doc_id", "seq").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated_chunks"),
        _count(chunks.join(docs, "doc_id", "left_anti"), "orphan_chunks"),
        _count(docs.where("n_chars > 0").join(chunks, "doc_id", "left_anti"), "chunkless"),
        seeds.agg(F.count_if(F.col("n_chars") > 0).alias("baselines"), F.count_if(F.coalesce("n_chars", F.lit(0)) == 0).alias("alerts")),
        _count(t("embeddings"), "vectors"),
    ]
    keyed = [p.withColumn("one", F.lit(1)) for p in parts]
    return reduce(lambda a, b: a.join(F.broadcast(b), "one"), keyed).drop("one")


@query("V_report", f"WITH n AS ({_NUMBERS}) " + " UNION ALL ".join(f"SELECT '{c}' AS check_name, {ok} AS ok, {shown}::BIGINT AS value FROM n" for c, ok, shown in CHECKS))
def v_report(t: Tables):
    """Every check with its verdict and number."""
    rows = F.array(*[F.struct(F.lit(c).alias("check_name"), F.expr(ok).alias("ok"), F.col(shown).cast("long").alias("value")) for c, ok, shown in CHECKS])
    return numbers(t).select(F.inline(rows))


@query("S_stats", f"SELECT documents, chunks, embedded, edges, facts, communities, vectors FROM ({_NUMBERS})")
def s_stats(t: Tables):
    """Totals of the corpus in one row."""
    return numbers(t).select("documents", "chunks", "embedded", "edges", "facts", "communities", "vectors")
