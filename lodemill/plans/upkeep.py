"""Queries p1, p3, p5 and p6: skew, incremental runs, repeated messages, orphans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.titles import name
from ..operators import dedup, incremental, orphans, skew
from ..session import cut, shared_dir, table
from .tables import alias_targets, known_pages, link_entries, month


def _targets(spark: SparkSession, root: str) -> DataFrame:
    """field_name, raw, source, at: every link entry and every relations row."""
    links = link_entries(spark, root, "doc_id").select(
        F.lit("outlinks").alias("field_name"), F.col("value").alias("raw"), F.xxhash64("doc_id").alias("source"), F.xxhash64("doc_id", "pos").alias("at")
    )
    rels = table(spark, root, "relations").select(
        F.lit("object").alias("field_name"), F.col("object").alias("raw"), F.xxhash64("subject").alias("source"), F.xxhash64("subject", "predicate", "source", "extracted_at").alias("at")
    )
    return links.unionByName(rels)


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Names with at least 2 % of all link entries, or of all relations rows; all rows count."""
    count = (lambda: F.count(F.lit(1)), lambda c: F.sum(c))
    by_value = skew.salted_aggregate(_targets(spark, root), ["field_name", "raw"], {"n": count}, salt_on=["at"])
    per_name = cut(by_value.groupBy("field_name", name(F.col("raw")).alias("name")).agg(F.sum("n").alias("n")))  # one for the totals and the shares
    totals = per_name.groupBy("field_name").agg(F.sum("n").alias("total"))  # two rows
    return per_name.join(F.broadcast(totals), "field_name").where("name IS NOT NULL AND n * 50 >= total").select("field_name", "name")


def p1_targets(spark: SparkSession, root: str) -> DataFrame:
    """Of each target page: how many references it has, and from how many pages.

    Repeats of a page by a source are counted before and after the one shuffle of all pairs, which spreads
    a page's sources; then pairs are salted by source, so each partial has its sources to itself.
    """
    named = _targets(spark, root).where("raw IS NOT NULL").withColumn("name", name(F.col("raw")))
    keys = ["field_name", "name"]
    heavy = skew.heavy_keys(named.where(F.pmod("at", F.lit(skew.ONE_IN)) == 0), keys)
    pairs = named.groupBy(*keys, "source").agg(F.count(F.lit(1)).alias("m"))
    return skew.salted_aggregate(
        pairs, keys, {"n_refs": (lambda: F.sum("m"), lambda c: F.sum(c)), "n_sources": (lambda: F.count(F.lit(1)), lambda c: F.sum(c))}, salt_on=["source"], heavy=heavy
    )


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents that the planned run takes up.

    The current rows of crawl_state are adopted as what earlier runs left; then a run over the documents
    descends its saved tree, and its published output is read back. Each call works in a folder of its own
    below the shared one, as the tables tell what was processed, not an earlier call.
    """
    planned = table(spark, root, "crawl_runs").where("status = 'planned'").agg(F.max("as_of")).first()  # one value
    state = incremental.latest_state(table(spark, root, "crawl_state"), "doc_id", "last_fetched", "last_hash", "next_due_at")
    runs = incremental.IncrementalRun(spark, f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}")
    runs.adopt(state.select(F.col("doc_id").alias("key"), F.lower("last_hash").alias("value"), F.col("next_due_at").alias("due")))
    docs = table(spark, root, "documents").select("doc_id", "content_hash")
    number = runs.run(docs, "doc_id", F.lower("content_hash"), lambda taken: taken.select("doc_id"), as_of=F.lit(planned[0]).cast("timestamp_ntz"))
    return runs.output(number)


def _copies(spark: SparkSession, root: str, columns: list[str], kept: bool) -> DataFrame:
    path = f"{root}/chunk_records.parquet"
    vectors = cut(dedup.survivors(spark, path, dedup.message_key(F.col("chunk_id"), F.col("content_hash")), F.col("record_id")))
    return dedup.apply_vectors(spark, path, vectors, columns, kept=kept)


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """record_id of every record that repeats one with a smaller record_id."""
    return _copies(spark, root, ["record_id"], kept=False)


def p5_kept(spark: SparkSession, root: str) -> DataFrame:
    """chunk_records whole, one record of each message."""
    return _copies(spark, root, table(spark, root, "chunk_records").columns, kept=True)


def _references(spark: SparkSession, root: str) -> DataFrame:
    links = link_entries(spark, root, "doc_id", "fetched_at").select(
        F.lit("documents").alias("table_name"), month("fetched_at").alias("period"), F.col("doc_id").cast("string").alias("ref_from"), F.col("value").alias("ref_to")
    )
    rels = table(spark, root, "relations").where("obj_kind = 'page' AND object IS NOT NULL").select(
        F.lit("relations").alias("table_name"), month("extracted_at").alias("period"), F.col("subject").alias("ref_from"), F.col("object").alias("ref_to")
    )
    aliases = table(spark, root, "redirects").where("canonical IS NOT NULL").select(
        F.lit("redirects").alias("table_name"), month("noticed_at").alias("period"), F.col("alias").alias("ref_from"), F.col("canonical").alias("ref_to")
    )
    return links.unionByName(rels).unionByName(aliases).distinct().withColumn("name", name(F.col("ref_to")))


def _orphans(spark: SparkSession, root: str) -> orphans.Orphans:
    return orphans.cascade(_references(spark, root), known_pages(spark, root), alias_targets(spark, root))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """References whose name no document, redirect or seed title provides."""
    return _orphans(spark, root).direct.select("table_name", "period", "ref_from", "ref_to")


def p6_inherited(spark: SparkSession, root: str) -> DataFrame:
    """References to an alias that leads, over any number of redirects, to nothing but unknown names."""
    return _orphans(spark, root).inherited.select("table_name", "period", "ref_from", "ref_to", "round")


def p6_report(spark: SparkSession, root: str) -> DataFrame:
    """Orphans by table, month and kind."""
    return _orphans(spark, root).report()


QUERIES = {f.__name__: f for f in (p1_found, p1_targets, p3_found, p5_found, p5_kept, p6_found, p6_inherited, p6_report)}

_NAME = "trim(regexp_replace(replace(nfc_normalize({0}), '_', ' '), '[\\s\\x{{A0}}\\x{{85}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}\\x{{1C}}-\\x{{1F}}]+', ' ', 'g'))"
_FILLED = "regexp_matches({0}, '[^\\s\\x{{A0}}\\x{{85}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}\\x{{1C}}-\\x{{1F}}]')"
_LINKS = f"SELECT * FROM (SELECT doc_id, fetched_at, unnest(outlinks) AS value FROM documents) WHERE value IS NOT NULL AND {_FILLED.format('value')}"
_KNOWN = f"""SELECT {_NAME.format('title')} AS name FROM documents UNION SELECT {_NAME.format('title')} FROM seed_titles UNION SELECT {_NAME.format('alias')} FROM redirects"""
_REFS = f"""known AS ({_KNOWN}), r AS (SELECT DISTINCT table_name, coalesce(strftime(ts, '%Y-%m'), 'none') AS period, ref_from, ref_to, {_NAME.format('ref_to')} AS name FROM (
            SELECT 'documents' AS table_name, fetched_at AS ts, doc_id::VARCHAR AS ref_from, value AS ref_to FROM ({_LINKS})
            UNION ALL SELECT 'relations', extracted_at, subject, object FROM relations WHERE obj_kind = 'page' AND object IS NOT NULL
            UNION ALL SELECT 'redirects', noticed_at, alias, canonical FROM redirects WHERE canonical IS NOT NULL))"""
#: An alias is saved if it reaches a page or goes round in a circle; the others fall, after the longest way to an unknown name.
_FALLEN = f"""pages AS (SELECT {_NAME.format('title')} AS name FROM documents WHERE title IS NOT NULL UNION SELECT {_NAME.format('title')} FROM seed_titles WHERE title IS NOT NULL),
        w AS (SELECT DISTINCT {_NAME.format('alias')} AS name, {_NAME.format('canonical')} AS target FROM redirects WHERE alias IS NOT NULL AND {_NAME.format('alias')} NOT IN (SELECT name FROM pages)),
        tc AS (SELECT name AS a, target AS b FROM w UNION SELECT tc.a, w.target FROM tc JOIN w ON tc.b = w.name),
        saved AS (SELECT DISTINCT a FROM tc WHERE b IN (SELECT name FROM pages) OR b IN (SELECT a FROM tc WHERE a = b)),
        fallen AS (SELECT * FROM w WHERE name NOT IN (SELECT a FROM saved)),
        ways AS (SELECT name, 1 AS n FROM fallen UNION SELECT fallen.name, ways.n + 1 FROM ways JOIN fallen ON fallen.target = ways.name),
        rounds AS (SELECT name, max(n)::INT AS round FROM ways GROUP BY name)"""
_COPY_KEYS = """SELECT *, split_part(chunk_id, ':', 1) AS k1, TRY_CAST(split_part(chunk_id, ':', 2) AS HUGEINT) AS k2, lower(content_hash) AS k3 FROM chunk_records"""

SQL = {
    "p1_found": f"""
        WITH t AS (SELECT 'outlinks' AS field_name, {_NAME.format('value')} AS name FROM ({_LINKS})
                   UNION ALL SELECT 'object', {_NAME.format('object')} FROM relations),
             n AS (SELECT field_name, name, count(*) AS n FROM t GROUP BY ALL)
        SELECT field_name, name FROM (SELECT *, sum(n) OVER (PARTITION BY field_name) AS total FROM n)
        WHERE name IS NOT NULL AND n >= 0.02 * total""",
    "p1_targets": f"""
        SELECT field_name, name, count(*)::BIGINT AS n_refs, count(DISTINCT source)::BIGINT AS n_sources FROM (
            SELECT 'outlinks' AS field_name, {_NAME.format('value')} AS name, doc_id::VARCHAR AS source FROM ({_LINKS})
            UNION ALL SELECT 'object', {_NAME.format('object')}, subject FROM relations WHERE object IS NOT NULL)
        GROUP BY ALL""",
    "p3_found": """
        WITH cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id
                        ORDER BY last_fetched DESC NULLS LAST, last_hash DESC NULLS LAST, next_due_at DESC NULLS LAST) AS rn FROM crawl_state) WHERE rn = 1)
        SELECT d.doc_id FROM documents d LEFT JOIN cur c ON c.doc_id = d.doc_id
        WHERE d.content_hash IS NOT NULL AND (c.doc_id IS NULL
            OR ((c.last_hash IS NULL OR lower(c.last_hash) <> lower(d.content_hash))
                AND (c.next_due_at IS NULL OR c.next_due_at <= (SELECT max(as_of) FROM crawl_runs WHERE status = 'planned'))))""",
    "p5_found": f"""
        SELECT record_id FROM (SELECT *, min(record_id) OVER (PARTITION BY k1, k2, k3) AS best FROM ({_COPY_KEYS})) WHERE record_id <> best""",
    "p5_kept": f"""
        SELECT * EXCLUDE (k1, k2, k3, best) FROM (SELECT *, min(record_id) OVER (PARTITION BY k1, k2, k3) AS best FROM ({_COPY_KEYS})) WHERE record_id = best""",
    "p6_found": f"""
        WITH {_REFS}
        SELECT table_name, period, ref_from, ref_to FROM r WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.name = r.name)""",
    "p6_inherited": f"""
        WITH RECURSIVE {_REFS}, {_FALLEN}
        SELECT table_name, period, ref_from, ref_to, round FROM r JOIN rounds USING (name)""",
    "p6_report": f"""
        WITH RECURSIVE {_REFS}, {_FALLEN}
        SELECT table_name, period, 'direct' AS kind, count(*) AS n FROM r WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.name = r.name) GROUP BY ALL
        UNION ALL SELECT table_name, period, 'inherited', count(*) FROM r JOIN rounds USING (name) GROUP BY ALL""",
}
