"""Graph queries (K): edges, PageRank, tiers, communities, neighbourhoods, paths, cards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import CALENDAR_WEEK, CHROME_TITLES, FLOOR, PERSON_PREDICATES, TIERS
from ..operators import graph
from ..operators.ranking import top_per_group
from .registry import Registry, Tables
from .relational import _EDGES, _FIRST, _INDEG, _STATE, asked, edges, first_pages, in_degree, state

query = Registry()
QUERIES, SQL = query.queries, query.sql

_CHROME = "', '".join(CHROME_TITLES)
_CALENDAR = CALENDAR_WEEK.replace("\\d", "[0-9]")
_RESOLVED = f"""(SELECT e.doc_id AS src, coalesce(d.doc_id, c.doc_id) AS dst FROM {_EDGES} e LEFT JOIN documents d ON d.title = e.dst
    LEFT JOIN (SELECT alias, min(canonical) AS canonical FROM redirects GROUP BY alias) a ON a.alias = e.dst LEFT JOIN documents c ON c.title = a.canonical
    WHERE e.dst NOT IN ('{_CHROME}') AND coalesce(d.doc_id, c.doc_id) IS NOT NULL)"""
_PAIRS = f"(SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM {_RESOLVED} WHERE src <> dst)"


def nodes(t: Tables):
    return t("documents").select(F.col("doc_id").alias("id"), "title")


def resolved_edges(t: Tables):
    """src, dst ids of all links between documents, by title or redirect, loops and repeats kept."""
    aliases = t("redirects").where("alias IS NOT NULL").groupBy("alias").agg(F.min("canonical").alias("canonical"))
    links = edges(t).select(F.col("doc_id").alias("src"), F.col("dst").alias("title"))
    return graph.resolve(links, nodes(t), aliases, CHROME_TITLES)


@query("K01_edges", f"SELECT src, dst FROM {_RESOLVED}")
def k01(t: Tables):
    return resolved_edges(t)


_RANKS = "SELECT doc_id, 1.0 / (SELECT count(*) FROM documents) AS r, 0 AS k FROM documents"
_ROUNDS = 30


@query("K02_pagerank", f"""WITH RECURSIVE e AS MATERIALIZED (SELECT src, dst FROM {_RESOLVED}), deg AS MATERIALIZED (SELECT src, count(*) AS g FROM e GROUP BY src),
    n AS (SELECT count(*)::DOUBLE AS n FROM documents), r0 AS (SELECT doc_id, 1.0::DOUBLE / n AS r FROM documents, n),
    {', '.join(f'''r{k} AS MATERIALIZED (SELECT d.doc_id, 0.15 / n.n + 0.85 * (SELECT coalesce(sum(r), 0) FROM r{k - 1} WHERE doc_id NOT IN (SELECT src FROM deg)) / n.n + 0.85 * coalesce(g.got, 0) AS r
    FROM documents d CROSS JOIN n LEFT JOIN (SELECT e.dst, sum(p.r / deg.g) AS got FROM e JOIN deg USING (src) JOIN r{k - 1} p ON p.doc_id = e.src GROUP BY e.dst) g ON g.dst = d.doc_id)''' for k in range(1, _ROUNDS + 1))}
    SELECT doc_id, CASE WHEN title NOT IN ('{_CHROME}') THEN round(r / (SELECT sum(r) FROM r{_ROUNDS}), 9)::DOUBLE END AS pagerank FROM r{_ROUNDS} JOIN documents USING (doc_id)""")
def k02(t: Tables):
    """PageRank after thirty rounds, fewer if the ranks settle before; pages of the interface get none."""
    ranks = graph.pagerank(nodes(t), resolved_edges(t), rounds=_ROUNDS)
    return ranks.join(nodes(t), "id").select(F.col("id").alias("doc_id"), F.when(~F.col("title").isin(*CHROME_TITLES), F.round("rank", 9)).alias("pagerank"))


_TIER = "CASE WHEN s.priority <= 10 THEN s.priority " + " ".join(f"WHEN coalesce(i.n, 0) >= {n} THEN {p}" for n, p in TIERS) + f" ELSE {FLOOR} END"


@query("K04_tiers", f"SELECT s.doc_id, ({_TIER})::BIGINT AS priority FROM {_STATE} s LEFT JOIN {_INDEG} i ON i.title = s.title")
def k04(t: Tables):
    """Crawl priorities by in-links, the highest threshold winning; rows of priority 10 and below stay."""
    n = F.coalesce("n", F.lit(0))
    tier = F.when(F.col("priority") <= 10, F.col("priority"))
    for least, priority in TIERS:
        tier = tier.when(n >= least, priority)
    return state(t).join(in_degree(t), "title", "left").select("doc_id", tier.otherwise(FLOOR).cast("long").alias("priority"))


@query("K05_in_link_distribution", "SELECT " + ", ".join(f"count(*) FILTER (WHERE coalesce(i.n, 0) >= {n})::BIGINT AS at_least_{n}" for n, _ in TIERS) + f", count(*) FILTER (WHERE i.n IS NULL)::BIGINT AS unlinked FROM {_STATE} s LEFT JOIN {_INDEG} i ON i.title = s.title WHERE s.last_fetched IS NULL")
def k05(t: Tables):
    """Pages never fetched by number of in-links: one pass for all thresholds."""
    per = state(t).where("last_fetched IS NULL").join(in_degree(t), "title", "left")
    return per.agg(*[F.count_if(F.coalesce("n", F.lit(0)) >= n).alias(f"at_least_{n}") for n, _ in TIERS], F.count_if(F.col("n").isNull()).alias("unlinked"))


@query("K06_next_to_crawl", f"SELECT s.doc_id, coalesce(i.n, 0)::BIGINT AS n FROM {_STATE} s LEFT JOIN {_INDEG} i ON i.title = s.title WHERE s.last_fetched IS NULL ORDER BY s.priority, n DESC, s.doc_id LIMIT 12")
def k06(t: Tables):
    per = state(t).where("last_fetched IS NULL").join(in_degree(t), "title", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return per.orderBy(F.asc_nulls_last("priority"), F.desc("n"), "doc_id").limit(12).select("doc_id", "n")


@query("K07_communities")
def k07(t: Tables):
    """Communities of the undirected link graph by label propagation."""
    found = graph.communities(graph.undirected(resolved_edges(t)))
    return found.select(F.col("node").alias("doc_id"), "community")


@query("K08_modularity", f"""WITH p AS MATERIALIZED {_PAIRS}, m AS (SELECT count(*)::DOUBLE AS m FROM p), l AS (SELECT doc_id, community FROM documents WHERE community IS NOT NULL),
    n AS (SELECT x.community AS ca, y.community AS cb FROM p LEFT JOIN l x ON x.doc_id = p.a LEFT JOIN l y ON y.doc_id = p.b),
    d AS (SELECT c, count(*) AS degree FROM (SELECT ca AS c FROM n UNION ALL SELECT cb FROM n) WHERE c IS NOT NULL GROUP BY c), i AS (SELECT ca AS c, count(*) AS inside FROM n WHERE ca = cb GROUP BY ca)
    SELECT d.c AS community, coalesce(i.inside, 0)::BIGINT AS inside, d.degree::BIGINT AS degree, round(coalesce(i.inside, 0) / m - (d.degree / (2 * m)) * (d.degree / (2 * m)), 9)::DOUBLE AS part FROM d LEFT JOIN i USING (c) CROSS JOIN m""")
def k08(t: Tables):
    """Modularity of the stored communities, by community."""
    labels = t("documents").where("community IS NOT NULL").select(F.col("doc_id").alias("node"), "community")
    return graph.modularity(graph.undirected(resolved_edges(t)), labels).withColumn("part", F.round("part", 9))


def seeds(t: Tables):
    """Ten seeds a question: the asked pages and the nine pages after each."""
    return t("documents").where("doc_id % 100 < 10").select((F.col("doc_id") - F.col("doc_id") % 100).alias("qid"), F.col("doc_id").alias("node"))


@query("K09_expand", f"""WITH e AS MATERIALIZED (SELECT DISTINCT src, dst FROM {_RESOLVED}), s AS (SELECT doc_id - doc_id % 100 AS qid, doc_id AS node FROM documents WHERE doc_id % 100 < 10),
    o AS (SELECT s.qid, e.dst AS node, count(*) AS shared FROM s JOIN e ON e.src = s.node GROUP BY ALL),
    f AS (SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.qid = o.qid AND s.node = o.node) AND EXISTS (SELECT 1 FROM s JOIN e ON e.dst = s.node WHERE s.qid = o.qid AND e.src = o.node))
    SELECT qid, node, shared::BIGINT AS shared, rk::BIGINT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY shared DESC, node) AS rk FROM f) WHERE rk <= 40""")
def k09(t: Tables):
    """Neighbours of seed groups that link back to any seed."""
    return graph.expand(resolved_edges(t), seeds(t), 40)


@query("K10_page_card", f"""SELECT q.doc_id, coalesce(len(q.categories), 0)::BIGINT AS categories, coalesce(len(q.outlinks), 0)::BIGINT AS out_degree,
    coalesce(array_to_string(list_sort(list_filter(q.outlinks, lambda x: x IS NOT NULL))[1:20], '|'), '') AS preview, coalesce(b.n, 0)::BIGINT AS backlinks
    FROM documents q LEFT JOIN (SELECT dst, count(DISTINCT doc_id) AS n FROM {_EDGES} GROUP BY dst) b ON b.dst = q.title WHERE q.doc_id % 100 = 0""")
def k10(t: Tables):
    """Categories, out-degree, first outlinks and backlinks of each asked page."""
    own = asked(t).select("doc_id", "title", "categories", "outlinks")
    back = edges(t).select("doc_id", F.col("dst").alias("title")).join(own, "title", "left_semi").groupBy("title").agg(F.countDistinct("doc_id").alias("n"))
    size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long")
    preview = F.array_join(F.slice(F.array_sort(F.filter("outlinks", lambda x: x.isNotNull())), 1, 20), "|")
    return own.join(back, "title", "left").select("doc_id", size("categories").alias("categories"), size("outlinks").alias("out_degree"), F.coalesce(preview, F.lit("")).alias("preview"), F.coalesce("n", F.lit(0)).alias("backlinks"))


@query("K11_entity_peers", """SELECT doc_id, peer_id, rk::BIGINT AS rank FROM (SELECT q.doc_id, d.doc_id AS peer_id, row_number() OVER (PARTITION BY q.doc_id ORDER BY d.pagerank DESC NULLS LAST, d.doc_id) AS rk
    FROM documents q JOIN documents d ON d.community = q.community AND d.doc_id <> q.doc_id WHERE q.doc_id % 100 = 0) WHERE rk <= 8""")
def k11_peers(t: Tables):
    """Eight pages of an asked page's community by pagerank: the first nine of each community, then joined."""
    docs = t("documents").where("community IS NOT NULL").select("community", F.col("doc_id").alias("peer_id"), "pagerank")
    order = [F.desc_nulls_last("pagerank"), F.col("peer_id")]
    first = top_per_group(docs, ["community"], order, 9, "place")
    own = asked(t).where("community IS NOT NULL").select("doc_id", "community")
    return top_per_group(own.join(first, "community").where("doc_id <> peer_id"), ["doc_id"], [F.col("place")], 8).select("doc_id", "peer_id", "rank")


@query("K11_entity_incoming", """SELECT doc_id, subject, predicate, source, rk::BIGINT AS rank FROM (SELECT q.doc_id, r.subject, r.predicate, r.source,
    row_number() OVER (PARTITION BY q.doc_id ORDER BY d.pagerank DESC NULLS LAST, r.subject, r.predicate, r.source) AS rk
    FROM documents q JOIN (SELECT DISTINCT subject, predicate, object, source FROM relations) r ON r.object = q.title LEFT JOIN documents d ON d.title = r.subject WHERE q.doc_id % 100 = 0) WHERE rk <= 40""")
def k11_incoming(t: Tables):
    """Relations that point at an asked page, by the subject's pagerank."""
    own = asked(t).select("doc_id", F.col("title").alias("object"))
    into = t("relations").select("subject", "predicate", "object", "source").join(own, "object").distinct()
    ranked = into.join(t("documents").select(F.col("title").alias("subject"), "pagerank"), "subject", "left")
    order = [F.desc_nulls_last("pagerank"), F.col("subject"), F.col("predicate"), F.col("source")]
    return top_per_group(ranked, ["doc_id"], order, 40).select("doc_id", "subject", "predicate", "source", "rank")


def topic_pairs(t: Tables):
    """Undirected links without calendar and interface pages."""
    dull = nodes(t).where(F.col("title").rlike(_CALENDAR) | F.col("title").isin(*CHROME_TITLES)).select("id")
    pairs = graph.undirected(resolved_edges(t))
    return pairs.join(dull, pairs.a == dull.id, "left_anti").join(dull, pairs.b == dull.id, "left_anti")


def path_ends(t: Tables):
    return t("documents").where("doc_id % 100 = 0").select(F.col("doc_id").alias("source"), (F.col("doc_id") + 37).alias("target"))


_DULL = f"(SELECT doc_id FROM documents WHERE regexp_matches(title, '{_CALENDAR}') OR title IN ('{_CHROME}'))"


@query("K12_path_lengths", f"""WITH RECURSIVE p AS MATERIALIZED (SELECT a, b FROM {_PAIRS} WHERE a NOT IN {_DULL} AND b NOT IN {_DULL}), u AS MATERIALIZED (SELECT a AS x, b AS y FROM p UNION SELECT b, a FROM p),
    h0 AS (SELECT doc_id AS source, doc_id AS node FROM documents WHERE doc_id % 100 = 0), {', '.join(f'h{k} AS MATERIALIZED (SELECT DISTINCT h.source, u.y AS node FROM h{k - 1} h JOIN u ON u.x = h.node)' for k in range(1, 5))}
    SELECT source, target, min(k)::BIGINT AS hops FROM (SELECT h.source, h.source + 37 AS target, h.k FROM ({' UNION ALL '.join(f'SELECT source, node, {k} AS k FROM h{k}' for k in range(5))}) h WHERE h.node = h.source + 37) GROUP BY ALL""")
def k12(t: Tables):
    """Steps between an asked page and another over undirected links, at most four."""
    return graph.paths(topic_pairs(t), path_ends(t), 4).select("source", "target", F.col("hops").cast("long").alias("hops"))


@query("K12_paths")
def k12_paths(t: Tables):
    """The shortest paths themselves, as ids."""
    return graph.paths(topic_pairs(t), path_ends(t), 4).select("source", "target", F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


_PICTURE = f"""WITH e AS MATERIALIZED (SELECT DISTINCT src, dst FROM {_EDGES} WHERE dst IS NOT NULL), q AS (SELECT doc_id, title, community FROM documents WHERE doc_id % 100 = 0),
    n AS (SELECT q.doc_id, q.community, e.dst AS near, true AS o, false AS i FROM q JOIN e ON e.src = q.title UNION ALL SELECT q.doc_id, q.community, e.src, false, true FROM q JOIN e ON e.dst = q.title),
    f AS (SELECT n.doc_id, d.doc_id AS near_id, bool_or(o) AS to_near, bool_or(i) AS from_near, row_number() OVER (PARTITION BY n.doc_id ORDER BY (any_value(d.community) IS NOT DISTINCT FROM any_value(n.community)) DESC, any_value(d.pagerank) DESC NULLS LAST, d.doc_id) AS rk
      FROM n JOIN documents d ON d.title = n.near WHERE d.doc_id <> n.doc_id AND d.title NOT IN ('{_CHROME}') AND NOT regexp_matches(d.title, '{_CALENDAR}') GROUP BY n.doc_id, d.doc_id)
    SELECT doc_id, near_id, to_near, from_near, to_near AND from_near AS mutual, rk::BIGINT AS rank FROM f WHERE rk <= 24"""


@query("K13_picture", _PICTURE)
def k13(t: Tables):
    """Pages to draw around an asked page: linked either way, those of its community first."""
    own = asked(t).select("doc_id", "title", "community")
    e = edges(t).select("src", "dst").distinct()
    to = own.join(e, F.col("title") == F.col("src")).select("doc_id", "community", F.col("dst").alias("near"), F.lit(True).alias("o"))
    fro = own.join(e, F.col("title") == F.col("dst")).select("doc_id", "community", F.col("src").alias("near"), F.lit(False).alias("o"))
    dull = F.col("near").isin(*CHROME_TITLES) | F.col("near").rlike(_CALENDAR)
    pages = t("documents").select(F.col("title").alias("near"), F.col("doc_id").alias("near_id"), F.col("community").alias("c"), "pagerank")
    flagged = to.unionByName(fro).where(~dull).groupBy("doc_id", "community", "near").agg(F.bool_or("o").alias("to_near"), F.bool_or(~F.col("o")).alias("from_near"))
    near = flagged.join(pages, "near").where("doc_id <> near_id")
    order = [F.col("community").eqNullSafe(F.col("c")).desc(), F.desc_nulls_last("pagerank"), F.col("near_id")]
    return top_per_group(near, ["doc_id"], order, 24).select("doc_id", "near_id", "to_near", "from_near", (F.col("to_near") & F.col("from_near")).alias("mutual"), "rank")


@query("K13_inner_edges", f"""WITH drawn AS MATERIALIZED (SELECT p.doc_id, d.title FROM ({_PICTURE}) p JOIN documents d ON d.doc_id = p.near_id), links AS MATERIALIZED (SELECT DISTINCT src, dst FROM {_EDGES} WHERE src <> dst),
    named AS (SELECT subject, object, min(predicate) AS label FROM relations WHERE source = 'infobox' AND obj_kind = 'page' GROUP BY ALL)
    SELECT a.doc_id, a.title AS src, b.title AS dst, label FROM links e JOIN drawn a ON a.title = e.src JOIN drawn b ON b.title = e.dst AND b.doc_id = a.doc_id LEFT JOIN named ON subject = e.src AND object = e.dst""")
def k13_inner(t: Tables):
    """Links between the pages drawn around an asked page, with the relation that names them, if any."""
    drawn = k13(t)
    shown = drawn.select("doc_id", "near_id").join(nodes(t).withColumnRenamed("id", "near_id"), "near_id").select("doc_id", "title")
    e = edges(t).select("src", "dst").where("src <> dst").distinct()
    inner = shown.withColumnRenamed("title", "src").join(e, "src").join(shown.withColumnRenamed("title", "dst"), ["doc_id", "dst"])
    labels = t("relations").where("source = 'infobox' AND obj_kind = 'page'").groupBy(F.col("subject").alias("src"), F.col("object").alias("dst")).agg(F.min("predicate").alias("label"))
    return inner.join(labels, ["src", "dst"], "left").select("doc_id", "src", "dst", "label")


@query("K14_community_listing", _FIRST.format("community", 6) + " ORDER BY size DESC, community LIMIT 30")
def k14(t: Tables):
    """The largest communities with their first pages."""
    return first_pages(t, "community", 6).orderBy(F.desc("size"), "community").limit(30)


@query("K15_type_listing", _FIRST.format("entity_type", 8))
def k15(t: Tables):
    return first_pages(t, "entity_type", 8)


@query("K16_redirect_folding", """WITH r AS (SELECT alias, min(canonical) AS canonical FROM redirects WHERE alias IS NOT NULL AND canonical IS NOT NULL GROUP BY alias)
    SELECT d.doc_id, c.doc_id AS canonical_id, CASE WHEN c.doc_id IS NULL THEN 'requeued' ELSE 'folded' END AS fate, (SELECT count(*) FROM chunks k WHERE k.doc_id = d.doc_id)::BIGINT AS tombstones
    FROM r JOIN documents d ON d.title = r.alias LEFT JOIN documents c ON c.title = r.canonical WHERE r.alias <> r.canonical""")
def k16(t: Tables):
    """Documents under an alias: folded into the canonical page if there is one, else queued under its title;
    either way their chunks are withdrawn."""
    r = t("redirects").where("alias IS NOT NULL AND canonical IS NOT NULL").groupBy("alias").agg(F.min("canonical").alias("canonical")).where("alias <> canonical")
    own = r.join(t("documents").select("doc_id", F.col("title").alias("alias")), "alias")
    both = own.join(t("documents").select(F.col("doc_id").alias("canonical_id"), F.col("title").alias("canonical")), "canonical", "left")
    chunks = t("chunks").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    fate = F.when(F.col("canonical_id").isNull(), "requeued").otherwise("folded")
    return both.join(chunks, "doc_id", "left").select("doc_id", "canonical_id", fate.alias("fate"), F.coalesce("n", F.lit(0)).alias("tombstones"))


@query("K17_facts", f"""SELECT qid, subject, predicate, object, rk::BIGINT AS rank FROM (SELECT s.qid, r.subject, r.predicate, r.object, row_number() OVER (PARTITION BY s.qid ORDER BY d.pagerank DESC NULLS LAST, r.predicate, r.subject, r.object) AS rk
    FROM (SELECT doc_id - doc_id % 100 AS qid, doc_id AS node FROM documents WHERE doc_id % 100 < 10) s JOIN documents d ON d.doc_id = s.node
    JOIN (SELECT DISTINCT subject, predicate, object FROM relations WHERE source = 'infobox') r ON r.subject = d.title
    WHERE NOT (r.predicate IN ('{"', '".join(PERSON_PREDICATES)}') AND coalesce(d.entity_type, '') <> 'person')) WHERE rk <= 24""")
def k17(t: Tables):
    """Facts of ten pages a question, the most central pages first."""
    pages = t("documents").where("doc_id % 100 < 10").select((F.col("doc_id") - F.col("doc_id") % 100).alias("qid"), F.col("title").alias("subject"), "pagerank", "entity_type")
    facts = t("relations").where("source = 'infobox'").select("subject", "predicate", "object").join(pages, "subject").distinct()
    wrong = F.col("predicate").isin(*PERSON_PREDICATES) & (F.coalesce("entity_type", F.lit("")) != "person")
    order = [F.desc_nulls_last("pagerank"), F.col("predicate"), F.col("subject"), F.col("object")]
    return top_per_group(facts.where(~wrong), ["qid"], order, 24).select("qid", "subject", "predicate", "object", "rank")


@query("K18_discovery", f"SELECT DISTINCT dst AS title, 'bfs' AS discovered_by, 200::BIGINT AS priority FROM {_EDGES} WHERE dst IS NOT NULL AND NOT EXISTS (SELECT 1 FROM crawl_state s WHERE s.title = dst)")
def k18(t: Tables):
    """Frontier rows for linked titles that the crawl doesn't know."""
    new = edges(t).select(F.col("dst").alias("title")).distinct().join(t("crawl_state"), "title", "left_anti")
    return new.select("title", F.lit("bfs").alias("discovered_by"), F.lit(200).cast("long").alias("priority"))


@query("K19_mutual_links", f"WITH e AS MATERIALIZED (SELECT DISTINCT src, dst FROM {_RESOLVED} WHERE src <> dst) SELECT a.src, a.dst, EXISTS (SELECT 1 FROM e b WHERE b.src = a.dst AND b.dst = a.src) AS mutual FROM e a")
def k19(t: Tables):
    """Every link between two documents, and whether it is returned."""
    e = resolved_edges(t).where("src <> dst").distinct()
    back = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(True).alias("x"))
    return e.join(back, ["src", "dst"], "left").select("src", "dst", F.col("x").isNotNull().alias("mutual"))
