"""Relational constructs: filters (B), joins (C), aggregates (D), windows (E), top-k (F), sets (G)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.values import CALENDAR_WEEK, CATEGORY_NOISE, NAMESPACES, NAVIGATION, PERSON_PREDICATES
from ..operators.keyed import latest, membership_join
from ..operators.ranking import global_rank, tile, top_per_group
from .registry import Registry, Tables

query = Registry()
QUERIES, SQL = query.queries, query.sql

_ASKED = "doc_id % 100 = 0"
_RULES = "', '".join
_NOW = "(SELECT max(as_of) FROM crawl_runs)"
_CALENDAR = CALENDAR_WEEK.replace("\\d", "[0-9]")
#: One state row a document: the latest fetch, a null being the oldest.
_STATE = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY last_fetched DESC NULLS LAST, title DESC NULLS LAST, discovered_by DESC NULLS LAST,
    last_hash DESC NULLS LAST, http_status DESC NULLS LAST, fail_count DESC NULLS LAST, priority DESC NULLS LAST, next_due_at DESC NULLS LAST, queued_at DESC NULLS LAST) AS rn
    FROM crawl_state WHERE doc_id IS NOT NULL) WHERE rn = 1)"""
_EDGES = "(SELECT doc_id, title AS src, unnest(outlinks) AS dst FROM documents)"


def edges(t: Tables):
    """doc_id, src, dst: one row an outlink, null entries left out, repeats kept."""
    return t("documents").select("doc_id", F.col("title").alias("src"), F.explode("outlinks").alias("dst")).where("dst IS NOT NULL")


def state(t: Tables):
    """One crawl_state row a document, its latest."""
    rows = t("crawl_state").where("doc_id IS NOT NULL")
    rest = [c for c in rows.columns if c not in ("doc_id", "last_fetched")]
    return latest(rows.select("doc_id", "last_fetched", *rest), ["doc_id"], F.col("last_fetched"))


def asked(t: Tables):
    """The documents that searches start from."""
    return t("documents").where(_ASKED)


def as_of(t: Tables):
    """The time queries take for now: the last as_of of the runs, in a one-row table with key one."""
    return t("crawl_runs").agg(F.max("as_of").alias("now")).withColumn("one", F.lit(1))


def with_now(df, t: Tables):
    return df.withColumn("one", F.lit(1)).join(F.broadcast(as_of(t)), "one").drop("one")


@query("B01_projection", "SELECT doc_id, title AS page, lang, coalesce(len(outlinks), 0)::BIGINT AS out_degree FROM documents")
def b01(t: Tables):
    """Columns under new names, a null array being of length 0."""
    return t("documents").select("doc_id", F.col("title").alias("page"), "lang", F.coalesce(F.size("outlinks").cast("long"), F.lit(0)).alias("out_degree")).withColumn(
        "out_degree", F.greatest("out_degree", F.lit(0).cast("long"))
    )


@query("B02_equality", "SELECT subject, predicate, object FROM relations WHERE source = 'infobox'")
def b02(t: Tables):
    return t("relations").where(F.col("source") == "infobox").select("subject", "predicate", "object")


@query("B03_isin", "SELECT doc_id, title FROM documents WHERE title IN (SELECT title FROM seed_titles)")
def b03(t: Tables):
    return t("documents").join(t("seed_titles"), "title", "left_semi").select("doc_id", "title")


@query("B04_not_in", "SELECT doc_id, title FROM documents WHERE NOT EXISTS (SELECT 1 FROM seed_titles s WHERE s.title = documents.title)")
def b04(t: Tables):
    return t("documents").join(t("seed_titles"), "title", "left_anti").select("doc_id", "title")


@query("B05_backlinks", f"""SELECT DISTINCT q.doc_id, d.doc_id AS from_id FROM documents q JOIN {_EDGES} d ON d.dst = q.title WHERE q.doc_id % 100 = 0""")
def b05(t: Tables):
    """Of every asked page, the pages that link to it."""
    to = asked(t).select("doc_id", "title")
    return edges(t).select(F.col("doc_id").alias("from_id"), "dst").join(to, F.col("dst") == F.col("title")).select("doc_id", "from_id").distinct()


@query("B06_overlap", "SELECT doc_id FROM documents WHERE list_has_any(outlinks, (SELECT list(title) FROM seed_titles))")
def b06(t: Tables):
    """Pages that link to any seed."""
    return edges(t).join(t("seed_titles"), F.col("dst") == F.col("title"), "left_semi").select("doc_id").distinct()


@query("B07_null", "SELECT chunk_id, doc_id, section_id IS NULL AS no_section FROM chunks WHERE embedded_at IS NULL")
def b07(t: Tables):
    return t("chunks").where(F.col("embedded_at").isNull()).select("chunk_id", "doc_id", F.col("section_id").isNull().alias("no_section"))


@query("B08_null_safe", "SELECT q.doc_id, count(*)::BIGINT AS peers FROM documents q JOIN documents d ON d.community IS NOT DISTINCT FROM q.community WHERE q.doc_id % 100 = 0 GROUP BY q.doc_id")
def b08(t: Tables):
    """Of every asked page, the pages of its community; no community counts as one."""
    sizes = t("documents").groupBy(F.col("community").alias("c")).agg(F.count(F.lit(1)).alias("peers"))
    return asked(t).join(sizes, F.col("community").eqNullSafe(F.col("c"))).select("doc_id", "peers")


@query("B09_regex", f"SELECT subject, object FROM relations WHERE obj_kind = 'literal' AND NOT regexp_matches(object, '{_CALENDAR}')")
def b09(t: Tables):
    """Literal objects that are no calendar titles."""
    return t("relations").where((F.col("obj_kind") == "literal") & ~F.col("object").rlike(_CALENDAR)).select("subject", "object")


@query("B10_either_way", f"""SELECT DISTINCT q.doc_id, d.doc_id AS near_id FROM documents q JOIN (
    SELECT src AS a, dst AS b FROM {_EDGES} UNION ALL SELECT dst, src FROM {_EDGES}) e ON e.a = q.title JOIN documents d ON d.title = e.b WHERE q.doc_id % 100 = 0 AND d.doc_id <> q.doc_id""")
def b10(t: Tables):
    """Pages that an asked page links to or that link to it."""
    e = edges(t).select("src", "dst")
    both = e.select(F.col("src").alias("a"), F.col("dst").alias("b")).unionByName(e.select(F.col("dst").alias("a"), F.col("src").alias("b")))
    ids = t("documents").select(F.col("title").alias("b"), F.col("doc_id").alias("near_id"))
    return asked(t).select("doc_id", F.col("title").alias("a")).join(both, "a").join(ids, "b").where("doc_id <> near_id").select("doc_id", "near_id").distinct()


@query("B11_negated", f"""SELECT r.subject, r.predicate, r.object FROM relations r LEFT JOIN documents d ON d.title = r.subject
    WHERE r.source = 'infobox' AND NOT (r.predicate IN ('{_RULES(PERSON_PREDICATES)}') AND coalesce(d.entity_type, '') <> 'person')""")
def b11(t: Tables):
    """Facts, without those that only persons can have on pages that are none."""
    kinds = t("documents").select(F.col("title").alias("subject"), "entity_type")
    wrong = F.col("predicate").isin(*PERSON_PREDICATES) & (F.coalesce("entity_type", F.lit("")) != "person")
    return t("relations").where("source = 'infobox'").join(kinds, "subject", "left").where(~wrong).select("subject", "predicate", "object")


@query("B12_due", f"""SELECT doc_id, title, priority FROM {_STATE} WHERE next_due_at <= {_NOW} AND (queued_at IS NULL OR queued_at < {_NOW} - INTERVAL 1 HOUR) AND fail_count < 5""")
def b12(t: Tables):
    """Pages due at a fixed time, not queued within the hour before, with fewer than five failures."""
    idle = F.col("queued_at").isNull() | (F.col("queued_at") < F.col("now") - F.expr("INTERVAL 1 HOUR"))
    return with_now(state(t), t).where((F.col("next_due_at") <= F.col("now")) & idle & (F.col("fail_count") < 5)).select("doc_id", "title", "priority")


@query("B13_namespaces", f"SELECT doc_id, dst FROM {_EDGES} WHERE dst IS NOT NULL AND NOT regexp_matches(dst, '^({'|'.join(NAMESPACES)})')")
def b13(t: Tables):
    """Outlinks to articles only."""
    return edges(t).where(~F.col("dst").rlike(f"^({'|'.join(NAMESPACES)})")).select("doc_id", "dst")


@query("B14_lengths", "SELECT chunk_id FROM chunks WHERE len(heading_path) >= 1 AND length(text) > 400")
def b14(t: Tables):
    return t("chunks").where((F.size("heading_path") >= 1) & (F.length("text") > 400)).select("chunk_id")


@query("B18_clean_categories", f"SELECT doc_id, c FROM (SELECT doc_id, unnest(categories) AS c FROM documents) WHERE c IS NOT NULL AND c <> '' AND NOT regexp_matches(c, '^({'|'.join(CATEGORY_NOISE)})') AND NOT contains(c, '{NAVIGATION}')")
def b18(t: Tables):
    """Categories that say what a page is: no notes of the site and no navigation."""
    c = F.col("c")
    return t("documents").select("doc_id", F.explode("categories").alias("c")).where((c != "") & ~c.rlike(f"^({'|'.join(CATEGORY_NOISE)})") & ~c.contains(NAVIGATION))


@query("B19_guards", "SELECT doc_id, coalesce(length(text), 0)::BIGINT AS chars, length(coalesce(text, '')) < 50 AS too_short, trim(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(13)) = '' AS blank FROM documents")
def b19(t: Tables):
    """Texts too short to parse, and blank ones (space, tab, line ends)."""
    text = F.coalesce("text", F.lit(""))
    return t("documents").select("doc_id", F.length(text).cast("long").alias("chars"), (F.length(text) < 50).alias("too_short"), (F.regexp_replace(text, "^[ \\t\\n\\r]+", "") == "").alias("blank"))


@query("B20_positive", "SELECT doc_id, n_chars FROM documents WHERE n_chars > 0")
def b20(t: Tables):
    return t("documents").where("n_chars > 0").select("doc_id", "n_chars")


@query("C01_chunks_documents", "SELECT c.chunk_id, d.title, len(c.heading_path)::BIGINT AS depth FROM chunks c JOIN documents d USING (doc_id)")
def c01(t: Tables):
    return t("chunks").join(t("documents").select("doc_id", "title"), "doc_id").select("chunk_id", "title", F.size("heading_path").cast("long").alias("depth"))


def in_degree(t: Tables):
    return edges(t).groupBy(F.col("dst").alias("title")).agg(F.count(F.lit(1)).alias("n"))


_INDEG = f"(SELECT dst AS title, count(*) AS n FROM {_EDGES} WHERE dst IS NOT NULL GROUP BY dst)"


@query("C02_frontier_in_degree", f"SELECT s.doc_id, i.n FROM {_STATE} s JOIN {_INDEG} i ON i.title = s.title WHERE s.last_fetched IS NULL AND i.n >= 2")
def c02(t: Tables):
    """Pages never fetched that at least two links name."""
    return state(t).where("last_fetched IS NULL").join(in_degree(t), "title").where("n >= 2").select("doc_id", "n")


@query("C03_relations_subject", "SELECT r.subject, r.predicate, r.object, d.doc_id FROM relations r LEFT JOIN documents d ON d.title = r.subject")
def c03(t: Tables):
    return t("relations").join(t("documents").select("doc_id", F.col("title").alias("subject")), "subject", "left").select("subject", "predicate", "object", "doc_id")


@query("C04_state_in_degree", f"SELECT s.doc_id, coalesce(i.n, 0)::BIGINT AS n FROM {_STATE} s LEFT JOIN {_INDEG} i ON i.title = s.title")
def c04(t: Tables):
    return state(t).join(in_degree(t), "title", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("n"))


@query("C05_orphan_chunks", "SELECT c.chunk_id FROM chunks c LEFT JOIN documents d USING (doc_id) WHERE d.doc_id IS NULL")
def c05(t: Tables):
    return t("chunks").join(t("documents"), "doc_id", "left_anti").select("chunk_id")


@query("C06_chunkless", "SELECT doc_id FROM documents d WHERE n_chars > 0 AND NOT EXISTS (SELECT 1 FROM chunks c WHERE c.doc_id = d.doc_id)")
def c06(t: Tables):
    return t("documents").where("n_chars > 0").join(t("chunks"), "doc_id", "left_anti").select("doc_id")


@query("C07_unlinked", f"SELECT doc_id FROM {_STATE} s WHERE last_fetched IS NULL AND NOT EXISTS (SELECT 1 FROM {_EDGES} e WHERE e.dst = s.title)")
def c07(t: Tables):
    """Pages never fetched that nobody links to."""
    return state(t).where("last_fetched IS NULL").join(edges(t).select(F.col("dst").alias("title")), "title", "left_anti").select("doc_id")


@query("C08_exists_flag", "SELECT doc_id, EXISTS (SELECT 1 FROM chunks c WHERE c.doc_id = d.doc_id) AS has_chunks FROM documents d")
def c08(t: Tables):
    """Existence as a column."""
    some = t("chunks").select("doc_id").distinct().withColumn("x", F.lit(True))
    return t("documents").join(some, "doc_id", "left").select("doc_id", F.col("x").isNotNull().alias("has_chunks"))


@query("C09_membership", "SELECT q.doc_id, d.doc_id AS linked_id FROM documents q JOIN documents d ON list_contains(q.outlinks, d.title) WHERE q.doc_id % 100 = 0")
def c09(t: Tables):
    """Pages whose title is in the outlinks of an asked page."""
    pages = t("documents").select(F.col("doc_id").alias("linked_id"), "title")
    return membership_join(asked(t).select("doc_id", "outlinks"), pages, "outlinks", "title").select("doc_id", "linked_id")


@query("C10_unnest", f"SELECT doc_id, dst FROM {_EDGES} WHERE dst IS NOT NULL")
def c10(t: Tables):
    return edges(t).select("doc_id", "dst")


@query("C11_induced", f"SELECT src, dst FROM {_EDGES} e WHERE src <> dst AND src IN (SELECT title FROM seed_titles) AND dst IN (SELECT title FROM seed_titles)")
def c11(t: Tables):
    """Links between seeds, without loops."""
    seeds = t("seed_titles").select("title")
    e = edges(t).where("src <> dst")
    return e.join(seeds, F.col("src") == F.col("title"), "left_semi").join(seeds, F.col("dst") == F.col("title"), "left_semi").select("src", "dst")


@query("C12_update_from", f"SELECT s.doc_id, CASE WHEN d.doc_id IS NULL THEN s.last_hash ELSE d.content_hash END AS last_hash FROM {_STATE} s LEFT JOIN documents d USING (doc_id)")
def c12(t: Tables):
    """State with the stored hash written over where a document has one to say."""
    new = t("documents").select("doc_id", F.col("content_hash").alias("h"), F.lit(True).alias("x"))
    return state(t).join(new, "doc_id", "left").select("doc_id", F.when(F.col("x"), F.col("h")).otherwise(F.col("last_hash")).alias("last_hash"))


@query("C13_alias_fallback", f"""WITH a AS (SELECT alias, min(canonical) AS canonical FROM redirects GROUP BY alias)
    SELECT e.doc_id, coalesce(d.doc_id, c.doc_id) AS to_id FROM {_EDGES} e LEFT JOIN documents d ON d.title = e.dst LEFT JOIN a ON a.alias = e.dst LEFT JOIN documents c ON c.title = a.canonical
    WHERE coalesce(d.doc_id, c.doc_id) IS NOT NULL""")
def c13(t: Tables):
    """Links resolved by title, else by redirect."""
    from .graphs import resolved_edges

    return resolved_edges(t).select(F.col("src").alias("doc_id"), F.col("dst").alias("to_id"))


@query("C14_predicates_per_page", "SELECT d.doc_id, coalesce(p.n, 0)::BIGINT AS predicates FROM documents d LEFT JOIN (SELECT subject, count(DISTINCT predicate) AS n FROM relations WHERE source = 'infobox' GROUP BY subject) p ON p.subject = d.title")
def c14(t: Tables):
    sets = t("relations").where("source = 'infobox'").groupBy(F.col("subject").alias("title")).agg(F.countDistinct("predicate").alias("n"))
    return t("documents").join(sets, "title", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("predicates"))


@query("C16_edge_labels", f"""SELECT e.src, e.dst, l.label FROM (SELECT DISTINCT src, dst FROM {_EDGES} WHERE dst IS NOT NULL) e
    JOIN (SELECT subject, object, min(predicate) AS label FROM relations WHERE source = 'infobox' AND obj_kind = 'page' GROUP BY subject, object) l ON l.subject = e.src AND l.object = e.dst""")
def c16(t: Tables):
    """Links between pages that a relation names; of several the least predicate."""
    labels = t("relations").where("source = 'infobox' AND obj_kind = 'page'").groupBy(F.col("subject").alias("src"), F.col("object").alias("dst")).agg(F.min("predicate").alias("label"))
    return edges(t).select("src", "dst").distinct().join(labels, ["src", "dst"])


@query("C17_not_yet_embedded", "SELECT r.record_id FROM chunk_records r WHERE NOT EXISTS (SELECT 1 FROM chunks c WHERE c.chunk_id = r.chunk_id AND c.content_hash = r.content_hash AND c.embedded_at IS NOT NULL)")
def c17(t: Tables):
    """Records whose chunk version is not embedded."""
    done = t("chunks").where("embedded_at IS NOT NULL").select("chunk_id", "content_hash")
    return t("chunk_records").join(done, ["chunk_id", "content_hash"], "left_anti").select("record_id")


@query("C18_seed_or_alias", "SELECT d.doc_id, s.title FROM documents d JOIN seed_titles s ON s.title = d.title UNION SELECT d.doc_id, s.title FROM documents d JOIN redirects r ON r.alias = d.title JOIN seed_titles s ON s.title = r.canonical")
def c18(t: Tables):
    """Documents that are a seed, by title or by redirect."""
    docs, seeds = t("documents").select("doc_id", "title"), t("seed_titles").select("title")
    by_alias = docs.join(t("redirects"), F.col("title") == F.col("alias")).select("doc_id", F.col("canonical").alias("title"))
    return docs.unionByName(by_alias).join(seeds, "title").select("doc_id", "title").distinct()


@query("C20_repair", "SELECT c.chunk_id, d.title, coalesce(len(d.categories), 0)::BIGINT AS categories FROM chunks c JOIN documents d USING (doc_id) WHERE c.embedded_at IS NULL")
def c20(t: Tables):
    d = t("documents").select("doc_id", "title", F.size(F.coalesce("categories", F.array().cast("array<string>"))).cast("long").alias("categories"))
    return t("chunks").where("embedded_at IS NULL").join(d, "doc_id").select("chunk_id", "title", "categories")


@query("D01_counts", "SELECT (SELECT count(*) FROM documents)::BIGINT AS documents, (SELECT count(*) FROM chunks)::BIGINT AS chunks, (SELECT count(*) FROM relations)::BIGINT AS relations")
def d01(t: Tables):
    counts = [t(n).agg(F.lit(1).alias("one"), F.count(F.lit(1)).alias(n)) for n in ("documents", "chunks", "relations")]
    return counts[0].join(F.broadcast(counts[1]), "one").join(F.broadcast(counts[2]), "one").drop("one")


@query("D02_filtered_counts", "SELECT count(*)::BIGINT AS chunks, count(*) FILTER (WHERE embedded_at IS NOT NULL)::BIGINT AS embedded FROM chunks")
def d02(t: Tables):
    return t("chunks").agg(F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("embedded_at").isNotNull()).alias("embedded"))


@query("D03_distinct", "SELECT source, count(DISTINCT predicate)::BIGINT AS predicates, count(DISTINCT subject)::BIGINT AS subjects FROM relations GROUP BY source")
def d03(t: Tables):
    return t("relations").groupBy("source").agg(F.countDistinct("predicate").alias("predicates"), F.countDistinct("subject").alias("subjects"))


@query("D04_edge_count", "SELECT coalesce(sum(len(outlinks)), 0)::BIGINT AS edges FROM documents")
def d04(t: Tables):
    return t("documents").agg(F.coalesce(F.sum(F.when(F.col("outlinks").isNotNull(), F.size("outlinks"))), F.lit(0)).alias("edges"))


@query("D05_group_count", "SELECT source, obj_kind, count(*)::BIGINT AS n FROM relations GROUP BY source, obj_kind")
def d05(t: Tables):
    return t("relations").groupBy("source", "obj_kind").agg(F.count(F.lit(1)).alias("n"))


@query("D06_in_degree", f"SELECT title, n::BIGINT AS n FROM {_INDEG}")
def d06(t: Tables):
    return in_degree(t)


@query("D07_having", "SELECT count(*)::BIGINT AS repeated FROM (SELECT subject, predicate, object, source FROM relations GROUP BY ALL HAVING count(*) > 1)")
def d07(t: Tables):
    """Relation keys that occur more than once."""
    return t("relations").groupBy("subject", "predicate", "object", "source").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("repeated"))


_FIRST = """SELECT {0}, string_agg(title, ' | ' ORDER BY rk) AS first_pages, max(size)::BIGINT AS size FROM (
    SELECT {0}, title, row_number() OVER (PARTITION BY {0} ORDER BY pagerank DESC NULLS LAST, title) AS rk, count(*) OVER (PARTITION BY {0}) AS size FROM documents WHERE {0} IS NOT NULL) WHERE rk <= {1} GROUP BY {0}"""


def first_pages(t: Tables, group: str, k: int):
    """Of each group its size and first k titles by pagerank."""
    docs = t("documents").where(F.col(group).isNotNull()).select(group, "title", "pagerank")
    sizes = docs.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    top = top_per_group(docs, [group], [F.desc_nulls_last("pagerank"), F.col("title")], k, "rk")
    named = top.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("rk", "title"))).alias("x"))
    return named.join(sizes, group).select(group, F.array_join(F.transform("x", lambda s: s.title), " | ").alias("first_pages"), "size")


@query("D08_ordered_collect", _FIRST.format("community", 6))
def d08(t: Tables):
    return first_pages(t, "community", 6)


@query("D09_largest_groups", "SELECT community, count(*)::BIGINT AS size FROM documents WHERE community IS NOT NULL GROUP BY community ORDER BY size DESC, community LIMIT 30")
def d09(t: Tables):
    return t("documents").where("community IS NOT NULL").groupBy("community").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "community").limit(30)


@query("D11_class_shares", "SELECT entity_type, count(*)::BIGINT AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6)::DOUBLE AS percent FROM documents GROUP BY entity_type")
def d11(t: Tables):
    per = t("documents").groupBy("entity_type").agg(F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1))
    total = t("documents").agg(F.count(F.lit(1)).alias("total"), F.lit(1).alias("one"))
    return per.join(F.broadcast(total), "one").select("entity_type", "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 6).alias("percent"))


@query("D12_predicate_sets", "SELECT subject, string_agg(predicate, '|' ORDER BY predicate) AS predicates FROM (SELECT DISTINCT subject, predicate FROM relations WHERE source = 'infobox') GROUP BY subject")
def d12(t: Tables):
    return t("relations").where("source = 'infobox'").groupBy("subject").agg(F.array_join(F.array_sort(F.collect_set("predicate")), "|").alias("predicates"))


@query("D13_chunks_per_page", "SELECT d.title, count(*)::BIGINT AS chunks FROM chunks c JOIN documents d USING (doc_id) WHERE c.embedded_at IS NULL GROUP BY d.title")
def d13(t: Tables):
    per = t("chunks").where("embedded_at IS NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"))
    return per.join(t("documents").select("doc_id", "title"), "doc_id").select("title", "chunks")


@query("D14_mean_median", "SELECT lang, round(avg(n_chars), 6)::DOUBLE AS mean_chars, quantile_cont(n_chars, 0.5)::DOUBLE AS median_chars FROM documents GROUP BY lang")
def d14(t: Tables):
    return t("documents").groupBy("lang").agg(F.round(F.avg("n_chars"), 6).alias("mean_chars"), F.percentile("n_chars", 0.5).alias("median_chars"))


@query("D19_ratio", "SELECT count(*) FILTER (WHERE obj_kind = 'page')::BIGINT AS linked, count(*)::BIGINT AS facts, count(*) FILTER (WHERE obj_kind = 'page') >= 0.7 * count(*) AS ok FROM relations WHERE source = 'infobox'")
def d19(t: Tables):
    r = t("relations").where("source = 'infobox'").agg(F.count_if(F.col("obj_kind") == "page").alias("linked"), F.count(F.lit(1)).alias("facts"))
    return r.withColumn("ok", F.col("linked") * 10 >= F.col("facts") * 7)


@query("E01_quartile_priority", """SELECT d.doc_id, (20 + (d.q - 1) * 20)::BIGINT AS priority FROM (SELECT doc_id, ntile(4) OVER (ORDER BY pagerank DESC NULLS LAST, doc_id) AS q FROM documents WHERE pagerank IS NOT NULL) d""")
def e01(t: Tables):
    """Quarters by pagerank, from ranks over the whole table that no single task makes."""
    ranked = global_rank(t("documents").where("pagerank IS NOT NULL").select("doc_id", "pagerank"), F.desc("pagerank"), F.asc("doc_id"))
    total = ranked.agg(F.max("rank").alias("total"), F.lit(1).alias("one"))
    quarter = tile(F.col("rank"), F.col("total"), 4)
    return ranked.withColumn("one", F.lit(1)).join(F.broadcast(total), "one").select("doc_id", (20 + (quarter - 1) * 20).cast("long").alias("priority"))


@query("E02_rank_per_group", "SELECT community, doc_id, row_number() OVER (PARTITION BY community ORDER BY pagerank DESC NULLS LAST, doc_id)::BIGINT AS rank FROM documents")
def e02(t: Tables):
    w = Window.partitionBy("community").orderBy(F.desc_nulls_last("pagerank"), "doc_id")
    return t("documents").select("community", "doc_id", F.row_number().over(w).cast("long").alias("rank"))


@query("E05_first_per_label", "SELECT subject, predicate, min(object) AS object FROM relations WHERE source = 'infobox' AND extracted_at IS NOT DISTINCT FROM (SELECT min(extracted_at) FROM relations r WHERE r.source = 'infobox' AND r.subject = relations.subject AND r.predicate = relations.predicate) GROUP BY subject, predicate")
def e05(t: Tables):
    """Of each subject and predicate the first object: least time, then least text; a null time only where all are null."""
    at = F.struct(F.col("extracted_at").isNull().alias("n"), "extracted_at", "object")
    return t("relations").where("source = 'infobox'").groupBy("subject", "predicate").agg(F.min(at).alias("m")).select("subject", "predicate", F.col("m.object").alias("object"))


@query("E06_sequence", "SELECT chunk_id, (row_number() OVER (PARTITION BY doc_id ORDER BY seq, chunk_id) - 1)::BIGINT AS place FROM chunks")
def e06(t: Tables):
    return t("chunks").select("chunk_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("seq"), "chunk_id")) - 1).cast("long").alias("place"))


@query("E07_failures_in_a_minute", """SELECT event_id, count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW)::BIGINT AS failures FROM events""")
def e07(t: Tables):
    """Failures of the last 60 seconds at each event of a source, not reset by a success."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy("us").rangeBetween(-59_999_999, 0)
    return t("events").withColumn("us", us).select("event_id", F.count_if(F.col("event_type") == "error").over(w).alias("failures"))


@query("F01_next_due", f"SELECT doc_id, priority, next_due_at FROM {_STATE} WHERE fail_count < 5 ORDER BY priority, next_due_at, doc_id LIMIT 100")
def f01(t: Tables):
    return state(t).where("fail_count < 5").orderBy(F.asc_nulls_last("priority"), F.asc_nulls_last("next_due_at"), "doc_id").limit(100).select("doc_id", "priority", "next_due_at")


@query("F02_top_pages", "SELECT doc_id, title FROM documents ORDER BY pagerank DESC NULLS LAST, title LIMIT 50")
def f02(t: Tables):
    return t("documents").orderBy(F.desc_nulls_last("pagerank"), "title").limit(50).select("doc_id", "title")


_KIND = "CASE source WHEN 'infobox' THEN 0 WHEN 'title' THEN 1 WHEN 'redirect' THEN 2 ELSE 3 END"


@query("F03_ranked_relations", f"""SELECT q.doc_id, r.predicate, r.object, r.rk::BIGINT AS rank FROM documents q JOIN (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY k, predicate, object) AS rk
    FROM (SELECT DISTINCT subject, predicate, object, {_KIND} AS k FROM relations)) r ON r.subject = q.title WHERE q.doc_id % 100 = 0 AND r.rk <= 40""")
def f03(t: Tables):
    """Of each asked page up to 40 relations, facts first, then parts, aliases and the rest."""
    kind = F.when(F.col("source") == "infobox", 0).when(F.col("source") == "title", 1).when(F.col("source") == "redirect", 2).otherwise(3)
    own = t("relations").select("subject", "predicate", "object", kind.alias("k")).join(asked(t).select("doc_id", F.col("title").alias("subject")), "subject").distinct()
    return top_per_group(own, ["doc_id"], [F.col("k"), F.col("predicate"), F.col("object")], 40).select("doc_id", "predicate", "object", "rank")


@query("F04_same_community_first", f"""SELECT doc_id, near_id, rk::BIGINT AS rank FROM (SELECT q.doc_id, d.doc_id AS near_id,
    row_number() OVER (PARTITION BY q.doc_id ORDER BY (d.community IS NOT DISTINCT FROM q.community) DESC, d.pagerank DESC NULLS LAST, d.doc_id) AS rk
    FROM documents q JOIN (SELECT DISTINCT src, dst FROM {_EDGES}) e ON e.src = q.title JOIN documents d ON d.title = e.dst WHERE q.doc_id % 100 = 0 AND d.doc_id <> q.doc_id) WHERE rk <= 24""")
def f04(t: Tables):
    """Linked pages of an asked page, those of its own community first."""
    pages = t("documents").select(F.col("doc_id").alias("near_id"), "title", F.col("community").alias("c"), "pagerank")
    near = membership_join(asked(t).select("doc_id", "community", "outlinks"), pages, "outlinks", "title").where("doc_id <> near_id")
    order = [F.col("community").eqNullSafe(F.col("c")).desc(), F.desc_nulls_last("pagerank"), F.col("near_id")]
    return top_per_group(near, ["doc_id"], order, 24).select("doc_id", "near_id", "rank")


@query("F05_by_length", "SELECT doc_id, coalesce(len(outlinks), 0)::BIGINT AS n FROM documents ORDER BY n DESC, doc_id LIMIT 50")
def f05(t: Tables):
    n = F.when(F.col("outlinks").isNull(), 0).otherwise(F.size("outlinks")).cast("long")
    return t("documents").select("doc_id", n.alias("n")).orderBy(F.desc("n"), "doc_id").limit(50)


@query("F08_slice", "SELECT doc_id, array_to_string(categories[1:3], '|') AS first_categories FROM documents WHERE categories IS NOT NULL")
def f08(t: Tables):
    return t("documents").where("categories IS NOT NULL").select("doc_id", F.array_join(F.slice("categories", 1, 3), "|").alias("first_categories"))


@query("F11_sorted_links", "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(outlinks, lambda x: x IS NOT NULL))), chr(10)) AS links FROM documents WHERE outlinks IS NOT NULL")
def f11(t: Tables):
    """Outlinks distinct and in byte order, as they are stored."""
    return t("documents").where("outlinks IS NOT NULL").select("doc_id", F.array_join(F.array_sort(F.array_distinct(F.filter("outlinks", lambda x: x.isNotNull()))), "\n").alias("links"))


@query("G01_difference", f"SELECT DISTINCT dst AS title FROM {_EDGES} WHERE dst IS NOT NULL EXCEPT SELECT title FROM crawl_state")
def g01(t: Tables):
    """Linked titles that the crawl doesn't know yet."""
    return edges(t).select(F.col("dst").alias("title")).distinct().join(t("crawl_state"), "title", "left_anti")


@query("G02_intersection", "SELECT subject FROM (SELECT subject, list_distinct(list(predicate)) AS p FROM relations WHERE source = 'infobox' GROUP BY subject) WHERE list_has_any(p, ['스승', '제자'])")
def g02(t: Tables):
    """Pages with any of two predicates."""
    sets = t("relations").where("source = 'infobox'").groupBy("subject").agg(F.collect_set("predicate").alias("p"))
    return sets.where(F.arrays_overlap("p", F.array(F.lit("스승"), F.lit("제자")))).select("subject")


@query("G03_distinct_in_order", """SELECT doc_id, string_agg(c, '|' ORDER BY i) AS categories FROM (SELECT doc_id, c, min(i) AS i FROM (
    SELECT doc_id, unnest(categories) AS c, generate_subscripts(categories, 1) AS i FROM documents) WHERE c IS NOT NULL GROUP BY doc_id, c) GROUP BY doc_id""")
def g03(t: Tables):
    """Categories without repeats, first places kept."""
    kept = F.array_distinct(F.filter("categories", lambda x: x.isNotNull()))
    return t("documents").where(F.size(kept) > 0).select("doc_id", F.array_join(kept, "|").alias("categories"))


@query("G06_large_groups", "SELECT doc_id, community FROM documents WHERE community IN (SELECT community FROM documents GROUP BY community HAVING count(*) >= 5)")
def g06(t: Tables):
    """Documents in communities of at least five."""
    large = t("documents").groupBy("community").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")
    return t("documents").join(large, "community", "left_semi").select("doc_id", "community")


@query("G07_mutual", f"SELECT DISTINCT a.src AS x, a.dst AS y FROM {_EDGES} a JOIN {_EDGES} b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst")
def g07(t: Tables):
    """Pairs of pages that link to each other."""
    e = edges(t).select("src", "dst").where("src <> dst").distinct()
    a, b = e.where("src < dst"), e.where("src > dst").select(F.col("src").alias("dst"), F.col("dst").alias("src"))
    return a.join(b, ["src", "dst"], "left_semi").select(F.col("src").alias("x"), F.col("dst").alias("y"))
