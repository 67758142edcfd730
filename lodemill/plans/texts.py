"""Text queries: scalar functions (H), extraction, chunks, relations and classes (T, G05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chunking, pages, text
from ..functions.titles import name
from ..functions.values import CATEGORY_NOISE, NAMESPACES, NAVIGATION
from ..operators import triples
from .registry import Registry, Tables
from .upkeep import _NAME

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query("H01_normalized_title", f"SELECT doc_id, {_NAME.format('title')} AS name FROM documents")
def h01(t: Tables):
    return t("documents").select("doc_id", name(F.col("title")).alias("name"))


@query("H02_doc_key", f"SELECT doc_id, sha1({_NAME.format('title')}) AS key FROM documents")
def h02(t: Tables):
    return t("documents").select("doc_id", text.doc_key(name(F.col("title"))).alias("key"))


@query("H03_chunk_key", "SELECT chunk_id, printf('%s:%05d', doc_id::VARCHAR, seq) AS key FROM chunks WHERE seq IS NOT NULL")
def h03(t: Tables):
    return t("chunks").where("seq IS NOT NULL").select("chunk_id", text.chunk_key(F.col("doc_id").cast("string"), F.col("seq")).alias("key"))


@query("H04_content_hash", "SELECT doc_id, sha256(text) AS hash, coalesce(sha256(text) = content_hash, false) AS same FROM documents WHERE text IS NOT NULL")
def h04(t: Tables):
    key = text.content_key(F.col("text"))
    return t("documents").where("text IS NOT NULL").select("doc_id", key.alias("hash"), F.coalesce(key == F.col("content_hash"), F.lit(False)).alias("same"))


@query("H05_point_key", """SELECT chunk_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', ('0x' || substr(h, 17, 1))::INT + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS point
    FROM (SELECT chunk_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(chunk_id)) AS h FROM chunks)""")
def h05(t: Tables):
    return t("chunks").select("chunk_id", text.point_key(F.col("chunk_id")).alias("point"))


@query("H06_url_decode", "SELECT doc_id, url_decode(url_encode(title)) AS title, url_decode(replace(title, '%', '%25') || '%20+') AS odd FROM documents")
def h06(t: Tables):
    odd = F.concat(F.replace("title", F.lit("%"), F.lit("%25")), F.lit("%20+"))
    return t("documents").select("doc_id", text.url_decoded(text.url_encoded(F.col("title"))).alias("title"), text.url_decoded(odd).alias("odd"))


@query("H07_url_encode", "SELECT doc_id, '/w/' || url_encode(title) AS path FROM documents")
def h07(t: Tables):
    return t("documents").select("doc_id", F.concat(F.lit("/w/"), text.url_encoded(F.col("title"))).alias("path"))


@query("H08_unescape")
def h08(t: Tables):
    return t("extracted_docs").select("doc_id", text.unescaped(F.col("body_html")).alias("text"))


@query("H09_plain_text")
def h09(t: Tables):
    """The readable text of every page's body."""
    return t("extracted_docs").select("doc_id", text.plain_text(F.col("body_html")).alias("text"))


@query("H10_blanks", "SELECT doc_id, regexp_replace(text, '[ \\t\\x{A0}\\x{200B}]+', ' ', 'g') AS text FROM documents")
def h10(t: Tables):
    return t("documents").select("doc_id", F.regexp_replace("text", text.BLANK, " ").alias("text"))


@query("H11_control", "SELECT doc_id, regexp_replace(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g') AS text FROM documents")
def h11(t: Tables):
    return t("documents").select("doc_id", text.without_control(F.col("text")).alias("text"))


_PARENT = "trim(regexp_extract(title, '(?s)^(.*)/[^/]*$', 1))"


@query("H13_parent_title", f"SELECT doc_id, CASE WHEN {_PARENT} <> '' AND {_PARENT} <> title THEN {_PARENT} END AS parent FROM documents")
def h13(t: Tables):
    return t("documents").select("doc_id", text.parent_title(F.col("title")).alias("parent"))


@query("H15_tail", "SELECT chunk_id, right(text, 128) AS tail FROM chunks")
def h15(t: Tables):
    return t("chunks").select("chunk_id", F.right("text", F.lit(128)).alias("tail"))


@query("H16_breadcrumb", "SELECT c.chunk_id, array_to_string(list_prepend(d.title, coalesce(c.heading_path, [])), ' > ') || chr(10) || coalesce(c.section_id, '') AS text FROM chunks c JOIN documents d USING (doc_id)")
def h16(t: Tables):
    both = t("chunks").join(t("documents").select("doc_id", "title"), "doc_id")
    return both.select("chunk_id", text.breadcrumb(F.col("title"), F.col("heading_path"), F.coalesce("section_id", F.lit(""))).alias("text"))


@query("H17_calendar", "SELECT object, count(*)::BIGINT AS n FROM relations WHERE regexp_matches(object, '^([0-9]{1,4}년(대)?|[0-9]{1,2}월( [0-9]{1,2}일)?)$') GROUP BY object")
def h17(t: Tables):
    return t("relations").where(F.col("object").rlike("^([0-9]{1,4}년(대)?|[0-9]{1,2}월( [0-9]{1,2}일)?)$")).groupBy("object").agg(F.count(F.lit(1)).alias("n"))


_HEAD = "regexp_extract(trim(regexp_replace(replace(c, '의', ' '), '[\\s\\x{A0}]+', ' ', 'g')), '[^ ]*$')"


@query("H18_head_noun", f"SELECT doc_id, c, {_HEAD} AS head FROM (SELECT doc_id, unnest(categories) AS c FROM documents) WHERE c IS NOT NULL")
def h18(t: Tables):
    return t("documents").select("doc_id", F.explode("categories").alias("c")).where("c IS NOT NULL").select("doc_id", "c", text.head_noun(F.col("c")).alias("head"))


@query("H20_depth", "SELECT chunk_id, section_id, len(string_split(section_id, '.'))::BIGINT AS depth FROM chunks WHERE section_id IS NOT NULL")
def h20(t: Tables):
    return t("chunks").where("section_id IS NOT NULL").select("chunk_id", "section_id", F.size(F.split("section_id", r"\.")).cast("long").alias("depth"))


@query("H23_rounding", "SELECT event_id, round_even(value, 2)::DOUBLE AS two, round_even(value, 4)::DOUBLE AS four FROM events")
def h23(t: Tables):
    return t("events").select("event_id", F.bround("value", 2).alias("two"), F.bround("value", 4).alias("four"))


@query("H24_bands", "SELECT doc_id, least(n_chars, 850)::BIGINT AS low, greatest(n_chars, 200)::BIGINT AS high, n_chars BETWEEN 200 AND 1275 AS within FROM documents")
def h24(t: Tables):
    return t("documents").select("doc_id", F.least("n_chars", F.lit(850)).alias("low"), F.greatest("n_chars", F.lit(200)).alias("high"), F.col("n_chars").between(200, 1275).alias("within"))


@query("H26_norms", "SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6)::DOUBLE AS norm FROM embeddings")
def h26(t: Tables):
    from ..functions.vectors import norm

    return t("embeddings").select("vec_id", F.round(norm(F.col("embedding")), 6).alias("norm"))


@query("H27_log1p", "SELECT event_id, round(ln(1 + greatest(value, 0)), 6)::DOUBLE AS weight FROM events")
def h27(t: Tables):
    return t("events").select("event_id", F.round(F.log1p(F.greatest("value", F.lit(0.0))), 6).alias("weight"))


@query("H28_times", "SELECT doc_id, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched FROM documents")
def h28(t: Tables):
    return t("documents").select("doc_id", F.substring(F.col("fetched_at").cast("string"), 1, 19).alias("fetched"))


@query("H30_shard", "SELECT doc_id, substr(k, 1, 2) || '/' || substr(k, 3, 2) || '/' || k || '.gz' AS path FROM (SELECT doc_id, lpad(doc_id::VARCHAR, greatest(4, length(doc_id::VARCHAR))::INT, '0') AS k FROM documents)")
def h30(t: Tables):
    return t("documents").select("doc_id", text.shard_path(F.col("doc_id").cast("string")).alias("path"))


@query("T02_sections")
def t02(t: Tables):
    """Sections of every page, with the reason where there are none."""
    return pages.per_page(t("extracted_docs"), "doc_id", "link_html", pages.section_rows, pages.SECTIONS)


@query("T02_section_texts")
def t02_texts(t: Tables):
    """The sections' readable texts; what stands before the first section only if it is long enough."""
    found = pages.per_page(t("extracted_docs"), "doc_id", "link_html", pages.section_rows, pages.SECTIONS).where("error IS NULL")
    plain = found.withColumn("text", text.plain_text(F.col("html")))
    return plain.where((F.col("level") >= 0) | (F.length("text") > pages.SHORTEST_LEAD)).select("doc_id", "place", "section_id", "heading", F.greatest("level", F.lit(0)).alias("level"), F.split("path", "\x1f").alias("path"), "text")


@query("T03_categories")
def t03(t: Tables):
    return pages.per_page(t("extracted_docs"), "doc_id", "link_html", lambda s: [(c,) for c in pages.categories(s)], "category string")


_SPACES = "|".join(n.rstrip(":") for n in NAMESPACES)


@query("T04_links", f"""SELECT DISTINCT doc_id, title FROM (SELECT doc_id, url_decode(substr(h, 4)) AS title FROM (SELECT doc_id, unnest(regexp_extract_all(link_html, 'href=[''"](/w/[^''"#]+)[''"]', 1)) AS h FROM extracted_docs) WHERE NOT contains(h, '?'))
    WHERE trim(title) <> '' AND NOT regexp_matches(title, '^({_SPACES}):')""")
def t04(t: Tables):
    """Links of every page, also those above its body."""
    return pages.per_page(t("extracted_docs"), "doc_id", "link_html", lambda s: [(x,) for x in pages.links(s)], "title string")


@query("G05_link_sets", f"""SELECT doc_id, count(DISTINCT title)::BIGINT AS links FROM (SELECT doc_id, url_decode(substr(h, 4)) AS title FROM (SELECT doc_id, unnest(regexp_extract_all(body_html, 'href=[''"](/w/[^''"#]+)[''"]', 1)) AS h FROM extracted_docs) WHERE NOT contains(h, '?'))
    WHERE trim(title) <> '' AND NOT regexp_matches(title, '^({_SPACES}):') GROUP BY doc_id""")
def g05(t: Tables):
    """The same of the body alone, in built-in expressions."""
    found = F.filter(F.regexp_extract_all("body_html", F.lit("""href=['"](/w/[^'"#]+)['"]"""), F.lit(1)), lambda h: ~h.contains("?"))
    titles = F.array_distinct(F.transform(found, lambda h: text.url_decoded(F.substring(h, 4, 1 << 20))))
    kept = F.filter(titles, lambda x: (F.trim(x) != "") & ~x.rlike(f"^({_SPACES}):"))
    return t("extracted_docs").where(F.size(kept) > 0).select("doc_id", F.size(kept).cast("long").alias("links"))


@query("T07_chunks")
def t07(t: Tables):
    """Chunks of every document's rendered text."""
    docs = t("documents").select("doc_id", "title", chunking.sections(F.col("text")).alias("sections"))
    return chunking.chunk(docs)


@query("T06_split")
def t06(t: Tables):
    """Every text cut without regard to its sections."""
    whole = F.array(F.struct(F.lit(None).cast("string").alias("id"), F.lit("").alias("path"), F.coalesce("text", F.lit("")).alias("text")))
    return chunking.chunk(t("documents").select("doc_id", "title", whole.alias("sections"))).select("doc_id", "seq", "text")


@query("T08_facts")
def t08(t: Tables):
    """Facts of every page's infobox, whatever their labels."""
    return triples.infobox_relations(t("extracted_docs"), "link_html", any_label=True)


@query("T09_title_relations", f"SELECT title AS subject, 'PART_OF' AS predicate, {_PARENT} AS object FROM documents WHERE {_PARENT} <> '' AND {_PARENT} <> title")
def t09(t: Tables):
    return triples.title_relations(t("documents")).select("subject", "predicate", "object")


_CLEAN = f"c <> '' AND NOT regexp_matches(c, '^({'|'.join(CATEGORY_NOISE)})') AND NOT contains(c, '{NAVIGATION}')"


@query("T10_category_relations", f"SELECT title AS subject, 'INSTANCE_OF' AS predicate, c AS object FROM (SELECT title, unnest(categories) AS c FROM documents) WHERE {_CLEAN}")
def t10(t: Tables):
    return triples.category_relations(t("documents")).select("subject", "predicate", "object")


@query("T11_redirect_relations", "SELECT alias AS subject, 'SAME_AS' AS predicate, canonical AS object FROM redirects WHERE alias IS NOT NULL AND canonical IS NOT NULL")
def t11(t: Tables):
    return triples.redirect_relations(t("redirects")).select("subject", "predicate", "object")


@query("T12_relations_of_tables", f"""SELECT subject, predicate, object, source, min(obj_kind) AS obj_kind FROM (SELECT title AS subject, 'PART_OF' AS predicate, {_PARENT} AS object, 'title' AS source, 'page' AS obj_kind FROM documents WHERE {_PARENT} <> '' AND {_PARENT} <> title
    UNION ALL SELECT title, 'INSTANCE_OF', c, 'category', 'literal' FROM (SELECT title, unnest(categories) AS c FROM documents) WHERE {_CLEAN}
    UNION ALL SELECT alias, 'SAME_AS', canonical, 'redirect', 'page' FROM redirects WHERE alias IS NOT NULL AND canonical IS NOT NULL) GROUP BY ALL""".replace("min(obj_kind) AS obj_kind", "obj_kind"))
def t12_tables(t: Tables):
    """Relations by title, category and redirect, one of each key."""
    docs = t("documents")
    whole = triples.build(triples.title_relations(docs), triples.category_relations(docs), triples.redirect_relations(t("redirects")))
    return whole.select("subject", "predicate", "object", "source", "obj_kind")


@query("T12_relations")
def t12(t: Tables):
    """Relations by infobox, title, category and redirect, one of each key, with their evidence."""
    docs = t("documents")
    boxes = triples.infobox_relations(t("extracted_docs"), "link_html")
    return triples.build(boxes, triples.title_relations(docs), triples.category_relations(docs), triples.redirect_relations(t("redirects")))


def _class_sql() -> str:
    tests = [f"WHEN regexp_matches(title, '^([0-9]{{1,4}}년(대)?|[0-9]{{1,2}}월( [0-9]{{1,2}}일)?)$') THEN '{triples.CLASSES['개념']}'"]
    listed = lambda words: "['" + "', '".join(words) + "']"
    tests += [f"WHEN list_has_any(p, {listed(keys)}) THEN '{triples.CLASSES[k]}'" for k, keys in triples.BY_PREDICATE.items()]
    hits = {
        k: f"len(list_filter(heads, lambda w: list_contains({listed(keys)}, w) OR " + " OR ".join(f"ends_with(w, '{x}')" for x in keys if len(x) >= 3) + "))"
        if any(len(x) >= 3 for x in keys) else f"len(list_filter(heads, lambda w: list_contains({listed(keys)}, w)))"
        for k, keys in triples.BY_CATEGORY.items()
    }
    best = f"greatest({', '.join(hits.values())})"
    tests += [f"WHEN {best} > 0 AND {hit} = {best} THEN '{triples.CLASSES[k]}'" for k, hit in hits.items()]
    own = "list_filter(coalesce(categories, [])[1:6], lambda c: c IS NOT NULL AND NOT starts_with(c, '분류:') AND NOT (title <> '' AND title <> c AND contains(c, title)))"
    heads = f"list_transform({own}, lambda c: regexp_extract(trim(regexp_replace(replace(c, '의', ' '), '[\\s\\x{{A0}}]+', ' ', 'g')), '[^ ]*$'))"
    return f"""SELECT doc_id, CASE {' '.join(tests)} ELSE '{triples.CLASSES['개념']}' END AS class FROM (SELECT d.doc_id, d.title, {heads} AS heads, coalesce(r.p, []) AS p FROM documents d
        LEFT JOIN (SELECT subject, list(DISTINCT predicate) AS p FROM relations WHERE source = 'infobox' GROUP BY subject) r ON r.subject = d.title)"""


@query("T13_classes", _class_sql())
def t13(t: Tables):
    """The class of every document from its title, categories and predicates."""
    sets = t("relations").where("source = 'infobox'").groupBy(F.col("subject").alias("title")).agg(F.collect_set("predicate").alias("p"))
    return t("documents").join(sets, "title", "left").select("doc_id", triples.entity_class(F.col("title"), F.col("categories"), F.col("p")).alias("class"))


@query("T14_category_changes", "SELECT d.doc_id FROM documents d JOIN extracted_docs e USING (doc_id) WHERE d.categories IS DISTINCT FROM e.categories")
def t14(t: Tables):
    """Documents whose categories changed, their order counting."""
    new = t("extracted_docs").select("doc_id", F.col("categories").alias("now"))
    return t("documents").join(new, "doc_id").where(~F.col("categories").eqNullSafe(F.col("now"))).select("doc_id")
