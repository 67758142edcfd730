"""State queries (A, W): latest versions, merges, tombstones, change detection, backoff, queues, canaries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import keyed
from ..sources.messages import from_messages, to_messages
from ..streaming import rules
from .registry import Registry, Tables
from .relational import _NOW, _STATE, state, with_now

query = Registry()
QUERIES, SQL = query.queries, query.sql

_LAST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY record_id DESC) AS rn FROM chunk_records) WHERE rn = 1)"


def last_records(t: Tables):
    return keyed.latest(t("chunk_records").where("chunk_id IS NOT NULL"), ["chunk_id"], F.col("record_id"))


@query("A02_messages", """SELECT 'docs.raw' AS topic, doc_id::VARCHAR AS key, doc_id, content_hash FROM documents""")
def a02(t: Tables):
    """Documents as messages and back, each under its key."""
    sent = to_messages(t("documents").select("doc_id", "title", "content_hash"), "doc_id", "docs.raw")
    return from_messages(sent, "doc_id LONG, title STRING, content_hash STRING")[0].select("topic", "key", "doc_id", "content_hash")


@query("A04_latest", f"SELECT chunk_id, record_id, content_hash FROM {_LAST} WHERE NOT coalesce(deleted, false)")
def a04(t: Tables):
    """The last record of every chunk, without those that end in a deletion."""
    return last_records(t).where(~F.coalesce("deleted", F.lit(False))).select("chunk_id", "record_id", "content_hash")


@query("A05_replay", "SELECT topic, partition, count(*)::BIGINT AS records, min(\"offset\") AS first_offset, max(\"offset\") AS last_offset FROM chunk_records GROUP BY topic, partition")
def a05(t: Tables):
    """What a replay from the first offset reads."""
    return t("chunk_records").groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


@query("A09_changes", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_valid(props)""")
def a09(t: Tables):
    """Polled changes as JSON; broken ones are left out."""
    parsed = t("events").select("event_id", F.from_json("props", "k LONG").alias("p"))
    return parsed.where("p IS NOT NULL").select("event_id", F.col("p.k").alias("k"))


@query("A10_titles", "SELECT title FROM documents")
def a10(t: Tables):
    """One column of the scan."""
    return t("documents").select("title")


@query("A11_seeds", "SELECT title, seeded_by FROM seed_titles s WHERE NOT EXISTS (SELECT 1 FROM crawl_state c WHERE c.title = s.title) AND title IS NOT NULL")
def a11(t: Tables):
    """Seeds that are new to the crawl."""
    return t("seed_titles").where("title IS NOT NULL").join(t("crawl_state"), "title", "left_anti").select("title", "seeded_by")


@query("A15_upsert", "SELECT alias, canonical FROM (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY noticed_at DESC NULLS LAST, canonical DESC) AS rn FROM redirects WHERE alias IS NOT NULL) WHERE rn = 1")
def a15(t: Tables):
    """Redirects written one after the other: the last of each alias holds."""
    rows = t("redirects").where("alias IS NOT NULL").select("alias", "noticed_at", "canonical")
    return keyed.latest(rows, ["alias"], F.col("noticed_at")).select("alias", "canonical")


@query("A16_conditional_upsert", f"""SELECT c.chunk_id, coalesce(n.content_hash, c.content_hash) AS content_hash, CASE WHEN n.chunk_id IS NULL OR n.content_hash = c.content_hash THEN c.embedded_at END AS embedded_at
    FROM chunks c LEFT JOIN (SELECT * FROM {_LAST} WHERE NOT coalesce(deleted, false)) n ON n.chunk_id = c.chunk_id""")
def a16(t: Tables):
    """New versions of chunks: the time of embedding stays only with the same hash."""
    new = last_records(t).where(~F.coalesce("deleted", F.lit(False))).select("chunk_id", F.col("content_hash").alias("h"), F.lit(True).alias("x"))
    both = t("chunks").select("chunk_id", "content_hash", "embedded_at").join(new, "chunk_id", "left")
    stays = F.col("x").isNull() | (F.col("h") == F.col("content_hash"))
    return both.select("chunk_id", F.coalesce("h", "content_hash").alias("content_hash"), F.when(stays, F.col("embedded_at")).alias("embedded_at"))


@query("A17_least_upsert", f"""SELECT s.doc_id, CASE WHEN x.title IS NULL THEN s.priority ELSE least(s.priority, 10) END::BIGINT AS priority, CASE WHEN x.title IS NULL THEN s.fail_count ELSE 0 END::BIGINT AS fail_count,
    CASE WHEN x.title IS NULL THEN s.next_due_at ELSE {_NOW} END AS next_due_at FROM {_STATE} s LEFT JOIN (SELECT DISTINCT title FROM seed_titles) x ON x.title = s.title""")
def a17(t: Tables):
    """Changed pages: due now, at priority 10 at most, failures forgotten."""
    changed = t("seed_titles").select("title").distinct().withColumn("x", F.lit(True))
    both = with_now(state(t).join(changed, "title", "left"), t)
    hit = F.col("x").isNotNull()
    return both.select(
        "doc_id", F.when(hit, F.least("priority", F.lit(10))).otherwise(F.col("priority")).cast("long").alias("priority"),
        F.when(hit, 0).otherwise(F.col("fail_count")).cast("long").alias("fail_count"), F.when(hit, F.col("now")).otherwise(F.col("next_due_at")).alias("next_due_at"),
    )


@query("A18_counters", "SELECT topic AS stage, CASE WHEN coalesce(deleted, false) THEN 'deleted' ELSE 'stored' END AS metric, count(*)::BIGINT AS value FROM chunk_records GROUP BY ALL")
def a18(t: Tables):
    kind = F.when(F.coalesce("deleted", F.lit(False)), "deleted").otherwise("stored")
    return t("chunk_records").groupBy(F.col("topic").alias("stage"), kind.alias("metric")).agg(F.count(F.lit(1)).alias("value"))


@query("A19_insert_ignore", "SELECT title, seeded_by AS discovered_by FROM seed_titles UNION ALL SELECT title, min(discovered_by) FROM crawl_state c WHERE NOT EXISTS (SELECT 1 FROM seed_titles s WHERE s.title = c.title) AND title IS NOT NULL GROUP BY title")
def a19(t: Tables):
    """Rows that are there stay, new keys come in once."""
    old = t("seed_titles").select("title", F.col("seeded_by").alias("discovered_by"))
    return keyed.insert_ignore(old, t("crawl_state").where("title IS NOT NULL").select("title", "discovered_by"), ["title"])


_GONE = f"(SELECT doc_id FROM {_STATE} WHERE http_status = 404)"


@query("A20_cascade", f"SELECT c.chunk_id, c.doc_id, true AS deleted FROM chunks c WHERE c.doc_id IN {_GONE}")
def a20(t: Tables):
    """Tombstones for the chunks of pages that are gone."""
    return t("chunks").join(state(t).where("http_status = 404"), "doc_id", "left_semi").select("chunk_id", "doc_id", F.lit(True).alias("deleted"))


@query("A21_tail", "SELECT c.chunk_id, c.seq FROM chunks c JOIN (SELECT doc_id, ceil(n_chars / 850.0) AS keep FROM documents WHERE n_chars IS NOT NULL) d USING (doc_id) WHERE c.seq >= d.keep")
def a21(t: Tables):
    """Chunks beyond the number a page has now, here one for every 850 characters."""
    keep = t("documents").where("n_chars IS NOT NULL").select("doc_id", F.ceil(F.col("n_chars") / 850.0).alias("keep"))
    return t("chunks").join(keep, "doc_id").where("seq >= keep").select("chunk_id", "seq")


@query("A22_vectors", "SELECT vec_id, len(embedding)::BIGINT AS width FROM embeddings")
def a22(t: Tables):
    """The vector table after all its rows were put again under their ids."""
    v = t("embeddings").select("vec_id", "embedding")
    return keyed.upsert(v, v, ["vec_id"]).select("vec_id", F.size("embedding").cast("long").alias("width"))


@query("A23_bad_json", "SELECT record_id, CASE WHEN record_id % 7 = 0 THEN 'dead' ELSE 'good' END AS fate FROM chunk_records")
def a23(t: Tables):
    """Values cut off are dead letters, the others rows."""
    sent = t("chunk_records").select("record_id", F.to_json(F.struct("chunk_id", "record_id")).alias("v"))
    broken = sent.select("record_id", F.when(F.col("record_id") % 7 == 0, F.concat(F.lit('{"chunk_id": '), F.lit("}"))).otherwise(F.col("v")).alias("value"))
    rows, dead = from_messages(broken.withColumnRenamed("record_id", "k"), "chunk_id STRING, record_id LONG")
    return rows.select(F.col("k").alias("record_id"), F.lit("good").alias("fate")).unionByName(dead.select(F.col("k").alias("record_id"), F.lit("dead").alias("fate")))


@query("A24_dead_letters", "SELECT doc_id, CASE WHEN text IS NULL THEN 'no text' ELSE 'too short' END AS error FROM documents WHERE text IS NULL OR length(text) < 50")
def a24(t: Tables):
    """Documents that cannot be chunked, with the reason."""
    return t("documents").where("text IS NULL OR length(text) < 50").select("doc_id", F.when(F.col("text").isNull(), "no text").otherwise("too short").alias("error"))


_KIND = "CASE event_type WHEN 'error' THEN 'failed' ELSE 'ok' END"


def fetch_events(t: Tables):
    """Events as fetches: an error fails, a purchase finds the page gone, the rest bring a hash."""
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "gone").otherwise("ok")
    return t("events").select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), "ts", kind.alias("kind"), F.floor(F.col("value") % 3).cast("string").alias("hash"))


_FETCH = "SELECT user_id AS key, event_id AS seq, ts, CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'gone' ELSE 'ok' END AS kind, floor(value % 3)::BIGINT::VARCHAR AS hash FROM events"
_OKS = f"(SELECT *, lag(hash) OVER (PARTITION BY key ORDER BY ts, seq) AS before FROM ({_FETCH}) WHERE kind = 'ok')"
_RUNS = f"(SELECT *, count(*) FILTER (WHERE kind = 'ok') OVER (PARTITION BY key ORDER BY ts, seq) AS part FROM ({_FETCH}))"


@query("W01_changes", f"SELECT key, seq, CASE WHEN before IS NOT NULL AND before = hash THEN 'unchanged' ELSE 'changed' END AS verdict FROM {_OKS}")
def w01(t: Tables):
    """Fetches that brought something new; failures and pages gone leave the stored hash as it is."""
    ok = fetch_events(t).where("kind = 'ok'")
    before = F.lag("hash").over(Window.partitionBy("key").orderBy("ts", "seq"))
    return ok.withColumn("b", before).select("key", "seq", F.when(F.col("b") == F.col("hash"), "unchanged").otherwise("changed").alias("verdict"))


@query("W02_parse_skip", "SELECT d.doc_id, coalesce(lower(s.last_hash) = d.content_hash, false) AND EXISTS (SELECT 1 FROM chunks c WHERE c.doc_id = d.doc_id) AND NOT EXISTS (SELECT 1 FROM seed_titles x WHERE x.title = d.title) AS skipped FROM documents d LEFT JOIN " + _STATE + " s USING (doc_id)")
def w02(t: Tables):
    """A page is left out of parsing only with an equal hash, with chunks, and if no canary."""
    some = t("chunks").select("doc_id").distinct().withColumn("c", F.lit(True))
    canaries = t("seed_titles").select("title").distinct().withColumn("x", F.lit(True))
    both = t("documents").join(state(t).select("doc_id", "last_hash"), "doc_id", "left").join(some, "doc_id", "left").join(canaries, "title", "left")
    same = F.coalesce(F.lower("last_hash") == F.col("content_hash"), F.lit(False))
    return both.select("doc_id", (same & F.col("c").isNotNull() & F.col("x").isNull()).alias("skipped"))


@query("W03_backoff", f"""SELECT key, seq, kind, (count(*) FILTER (WHERE kind = 'failed') OVER (PARTITION BY key, part ORDER BY ts, seq))::BIGINT AS fail_count,
    ts + CASE kind WHEN 'gone' THEN INTERVAL 90 DAY WHEN 'ok' THEN INTERVAL 14 DAY ELSE INTERVAL 10 MINUTE * (count(*) FILTER (WHERE kind = 'failed') OVER (PARTITION BY key, part ORDER BY ts, seq)) END AS next_due_at FROM {_RUNS}""")
def w03(t: Tables):
    """Failures in a row and the next visit after each fetch, by the rule that streams apply event by event."""
    out = rules.fetch_outcomes(fetch_events(t))
    kind = F.when(F.col("verdict").isin("changed", "unchanged"), "ok").otherwise(F.col("verdict"))
    return out.select("key", "seq", kind.alias("kind"), F.col("fail_count").cast("long").alias("fail_count"), "next_due_at")


@query("W04_gone", f"SELECT doc_id, title, true AS deleted, last_fetched + INTERVAL 90 DAY AS next_due_at FROM {_STATE} WHERE http_status = 404")
def w04(t: Tables):
    """Pages that are gone, as tombstones, and when they are looked for again."""
    return state(t).where("http_status = 404").select("doc_id", "title", F.lit(True).alias("deleted"), (F.col("last_fetched") + F.expr("INTERVAL 90 DAY")).alias("next_due_at"))


_FLYING = f"(SELECT count(*) FROM {_STATE} WHERE queued_at > {_NOW} - INTERVAL 1 HOUR AND (last_fetched IS NULL OR last_fetched < queued_at))"


@query("W05_refill", f"""SELECT doc_id, place::BIGINT AS place FROM (SELECT doc_id, row_number() OVER (ORDER BY priority NULLS LAST, next_due_at NULLS LAST, doc_id) AS place FROM {_STATE}
    WHERE next_due_at <= {_NOW} AND (queued_at IS NULL OR queued_at < {_NOW} - INTERVAL 1 HOUR) AND fail_count < 5) WHERE place <= greatest(0, 2000 - {_FLYING})""")
def w05(t: Tables):
    """What is queued next: due pages up to 2,000 in flight."""
    rows = with_now(state(t), t)
    hour = F.col("now") - F.expr("INTERVAL 1 HOUR")
    flying = rows.where((F.col("queued_at") > hour) & (F.col("last_fetched").isNull() | (F.col("last_fetched") < F.col("queued_at")))).agg(F.count(F.lit(1)).alias("flying")).withColumn("one", F.lit(1))
    due = rows.where((F.col("next_due_at") <= F.col("now")) & (F.col("queued_at").isNull() | (F.col("queued_at") < hour)) & (F.col("fail_count") < 5))
    order = [F.asc_nulls_last("priority"), F.asc_nulls_last("next_due_at"), F.col("doc_id")]
    first = due.orderBy(*order).limit(2000)
    placed = first.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long")).withColumn("one", F.lit(1))
    return placed.join(F.broadcast(flying), "one").where(F.col("place") <= 2000 - F.col("flying")).select("doc_id", "place")


@query("W07_rate_limit", """SELECT event_id, (max(us - i * 1000000) OVER (PARTITION BY user_id ORDER BY i) + i * 1000000)::BIGINT AS slot FROM (SELECT event_id, user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)""")
def w07(t: Tables):
    """When each request of a source may start, a second apart: its arrival or the slot before plus one."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = t("events").select("event_id", "user_id", "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), (F.row_number().over(w) - 1).cast("long").alias("i"))
    ahead = F.max(F.col("us") - F.col("i") * 1_000_000).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("event_id", (ahead + F.col("i") * 1_000_000).alias("slot"))


@query("W08_breaker")
def w08(t: Tables):
    """Whether the breaker of a source is open at each event, with resets."""
    return rules.breaker(fetch_events(t))


@query("W10_canaries", """WITH d AS (SELECT source, n_chars, fetched_at, doc_id FROM documents WHERE n_chars > 0 AND fetched_at IS NOT NULL),
    b AS (SELECT source, arg_min(n_chars, (fetched_at, doc_id)) AS baseline, arg_max(n_chars, (fetched_at, doc_id)) AS latest FROM d GROUP BY source)
    SELECT source, baseline, latest, CASE WHEN abs(latest - baseline) * 10 <= baseline * 3 THEN 'ok' ELSE 'ALERT' END AS status FROM b""")
def w10(t: Tables):
    """Of each source the first length, the last, and whether it is within 30 %."""
    at = F.struct("fetched_at", "doc_id")
    per = t("documents").where("n_chars > 0 AND fetched_at IS NOT NULL").groupBy("source").agg(F.min_by("n_chars", at).alias("baseline"), F.max_by("n_chars", at).alias("latest"))
    within = F.abs(F.col("latest") - F.col("baseline")) * 10 <= F.col("baseline") * 3
    return per.withColumn("status", F.when(within, "ok").otherwise("ALERT"))


@query("W11_baselines", "SELECT s.title, d.n_chars AS baseline FROM seed_titles s JOIN documents d ON d.title = s.title WHERE d.n_chars > 0")
def w11(t: Tables):
    return t("seed_titles").join(t("documents").select("title", "n_chars"), "title").where("n_chars > 0").select("title", F.col("n_chars").alias("baseline"))


@query("W12_versions_once", "SELECT DISTINCT chunk_id, content_hash FROM chunk_records WHERE content_hash IS NOT NULL")
def w12(t: Tables):
    """Each version of a chunk once."""
    return t("chunk_records").where("content_hash IS NOT NULL").select("chunk_id", "content_hash").distinct()


@query("W13_repairs", "SELECT doc_id, 'chunkless' AS reason FROM documents d WHERE n_chars > 0 AND NOT EXISTS (SELECT 1 FROM chunks c WHERE c.doc_id = d.doc_id) UNION ALL SELECT DISTINCT doc_id, 'unembedded' FROM chunks WHERE embedded_at IS NULL AND doc_id IN (SELECT doc_id FROM documents)")
def w13(t: Tables):
    """Documents to be sent again, and why."""
    bare = t("documents").where("n_chars > 0").join(t("chunks"), "doc_id", "left_anti").select("doc_id", F.lit("chunkless").alias("reason"))
    late = t("chunks").where("embedded_at IS NULL").join(t("documents"), "doc_id", "left_semi").select("doc_id", F.lit("unembedded").alias("reason")).distinct()
    return bare.unionByName(late)


@query("A08_page_heads", "SELECT doc_id, starts_with(ltrim(lower(left(link_html, 1024))), '<!doctype html') OR contains(lower(left(link_html, 1024)), '<html') AS ok FROM extracted_docs WHERE link_html IS NOT NULL")
def a08(t: Tables):
    """Whether a fetched body begins like a page."""
    from ..sources.blobs import looks_like_html

    return t("extracted_docs").where("link_html IS NOT NULL").select("doc_id", looks_like_html(F.col("link_html").cast("binary")).alias("ok"))


@query("A07_blob_refs", "SELECT doc_id, blob_ref = 'blob://' || lpad(doc_id::VARCHAR, 12, '0') AS regular, substr(blob_ref, 8, 2) || '/' || substr(blob_ref, 10, 2) || '/' || substr(blob_ref, 8) || '.gz' AS path FROM documents WHERE blob_ref IS NOT NULL")
def a07(t: Tables):
    """Where the blobs of documents lie."""
    key = F.regexp_replace("blob_ref", "^blob://", "")
    own = F.concat(F.lit("blob://"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    return t("documents").where("blob_ref IS NOT NULL").select("doc_id", (F.col("blob_ref") == own).alias("regular"), text.shard_path(key).alias("path"))
