"""Streams end where the batch does; keyed tables; blobs; messages; the state machines."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lodemill.operators import keyed, retrieval
from lodemill.sources import blobs, messages
from lodemill.sources.versioned import VersionedTable
from lodemill.streaming import ingest, rules

T0 = datetime(2026, 1, 1)
EVENTS = "key long, seq long, ts timestamp_ntz, kind string, hash string"


def events(spark):
    rows = []
    for k in range(6):
        for n in range(30):
            kind = "gone" if (k, n) == (2, 9) else "failed" if (n * (k + 3)) % 7 < 3 else "ok"
            rows.append((k, k * 100 + n, T0 + timedelta(minutes=n), kind, str(n // 5) if kind == "ok" else None))
    return spark.createDataFrame(rows, EVENTS)


def test_backoff(spark):
    rows = [(1, i, T0 + timedelta(seconds=i), kind, h) for i, (kind, h) in enumerate([("ok", "a"), ("failed", None), ("failed", None), ("ok", "a"), ("gone", None), ("ok", "b")] + [("failed", None)] * 5)]
    got = rules.fetch_outcomes(spark.createDataFrame(rows, EVENTS)).orderBy("seq").collect()
    assert [r.verdict for r in got] == ["changed", "failed", "failed", "unchanged", "gone", "changed"] + ["failed"] * 5
    assert [r.fail_count for r in got] == [0, 1, 2, 0, 0, 0, 1, 2, 3, 4, 5]
    assert got[2].next_due_at - rows[2][2] == timedelta(minutes=20) and got[4].next_due_at - rows[4][2] == timedelta(days=90)
    assert [r.retried for r in got][-2:] == [True, False]


def test_breaker(spark):
    gaps = [0, 10, 10, 10, 10, 5, 700, 1, 1, 1, 1, 1]
    kinds = ["failed"] * 5 + ["ok", "failed", "failed", "ok", "failed", "failed", "failed"]
    at, rows = T0, []
    for i, (g, k) in enumerate(zip(gaps, kinds)):
        at += timedelta(seconds=g)
        rows.append((1, i, at, k, None))
    got = rules.breaker(spark.createDataFrame(rows, EVENTS)).orderBy("seq").collect()
    assert [r.open for r in got] == [False] * 5 + [True] + [False] * 6
    assert got[4].open_until == rows[4][2] + rules.PAUSE


def test_stream_of_outcomes_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    for k, part in enumerate(((0, 10), (10, 20), (20, 30))):
        events(spark).where(f"seq % 100 >= {part[0]} AND seq % 100 < {part[1]}").coalesce(1).write.mode("append").parquet(source)
    want = {tuple(r) for r in rules.fetch_outcomes(events(spark)).collect()}
    out = str(tmp_path / "out")
    files = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    ingest.outcomes(files).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(out).collect()]
    assert len(got) == len(want)
    assert {r[:2] for r in got} == {r[:2] for r in want}


def test_chunk_stream(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/chunks", ingest.CHUNKS)
    put = lambda c, o, text, gone=False: json.dumps({"chunk_id": c, "doc_id": 1, "seq": 0, "content_hash": text, "text": text, "deleted": gone, "offset": o})
    batches = [[put("a", 1, "x"), put("b", 2, "y"), "not json", put("a", 1, "x")], [put("a", 4, "new"), put("b", 3, None, True), put("c", 5, "z"), "{broken"], [put("a", 2, "late")]]
    (tmp_path / "in").mkdir()
    for k, batch in enumerate(batches):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps({"value": v}) for v in batch))
    run = lambda: ingest.chunk_messages(messages.stream(spark, str(tmp_path / "in"), "value string", files_per_trigger=1), table, str(tmp_path / "dead"), str(tmp_path / "cp")).awaitTermination()
    run()
    assert sorted((r.chunk_id, r.text) for r in ingest.living(table).collect()) == [("a", "new"), ("c", "z")]
    assert sorted(r.value for r in spark.read.json(str(tmp_path / "dead/*")).collect()) == ["not json", "{broken"]
    last = table.version()
    run()  # nothing new
    assert table.version() == last
    stream = json.loads((tmp_path / "cp" / "metadata").read_text())["id"]
    assert table.applied(stream) == 2
    table.replace(table.read().limit(0), (stream, 2))  # a batch that comes again
    assert ingest.living(table).count() == 2 and table.version() == last
    assert sorted(p.name for p in (tmp_path / "chunks").glob("version-*")) == ["version-1", "version-2"]


def test_into_table(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/state", "key long, seq long, kind string")
    events(spark).select("key", "seq", "kind").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("key long, seq long, kind string").parquet(str(tmp_path / "in"))
    ingest.into_table(stream, table, ["key"], "seq", str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.seq for r in table.read().collect()) == [k * 100 + 29 for k in range(6)]


def test_late_and_replayed_rows(spark, tmp_path):
    """An older row in a later batch loses; a table filled by hand and a replay under a new checkpoint lose nothing."""
    schema = "key long, seq long, kind string"
    table = VersionedTable(spark, f"file://{tmp_path}/state", schema)
    put = lambda *rows: spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda cp: ingest.into_table(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), table, ["key"], "seq", str(tmp_path / cp)).awaitTermination()
    table.replace(spark.createDataFrame([(7, 7, "by hand")], schema))
    put((1, 9, "new"), (2, 1, "a"))
    run("one")
    put((1, 3, "old"), (3, 1, "b"))
    run("one")
    want = [(1, 9, "new"), (2, 1, "a"), (3, 1, "b"), (7, 7, "by hand")]
    assert sorted(map(tuple, table.read().collect())) == want
    put((4, 1, "c"))
    run("two")  # from the start
    assert sorted(map(tuple, table.read().collect())) == sorted([*want, (4, 1, "c")])


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", "k long, v string")
    assert table.read().count() == 0 and table.version() == -1
    rows = lambda *x: spark.createDataFrame(list(x), "k long, v string")
    table.upsert(rows((1, "a"), (2, "b")), ["k"])
    table.upsert(rows((2, "c"), (3, "d")), ["k"])
    table.insert_ignore(rows((3, "no"), (4, "e"), (4, "f")), ["k"])
    table.delete(rows((1, "")), ["k"])
    assert sorted(map(tuple, table.read().collect())) == [(2, "c"), (3, "d"), (4, "e")]


def test_blobs(spark, tmp_path):
    data = [("abcdef", b"<html>"), ("x", "가".encode() * 1000), ("none", None)]
    df = spark.createDataFrame(data, "k string, d binary")
    put = {r.key: (r.blob_ref, r.byte_size) for r in blobs.put(df, "k", "d", str(tmp_path / "b")).collect()}
    assert put["abcdef"] == ("blob://abcdef", 6) and (tmp_path / "b/ab/cd/abcdef.gz").exists()
    got = {r.blob_ref: bytes(r.data) for r in blobs.read(spark, str(tmp_path / "b")).collect()}
    assert got == {"blob://abcdef": b"<html>", "blob://000x": data[1][1], "blob://none": b""}
    assert not list((tmp_path / "b").rglob("*.tmp"))


def test_latest_and_membership(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 2, "b"), (2, None, "c"), (2, None, "d"), (3, 5, "e")], "k long, o long, v string")
    assert sorted(map(tuple, keyed.latest(df, ["k"], F.col("o")).collect())) == [(1, 2, "b"), (2, None, "d"), (3, 5, "e")]
    left = spark.createDataFrame([(1, ["a", "b", "a", None]), (2, []), (3, None)], "id long, xs array<string>")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 12), ("z", 13)], "x string, y long")
    assert sorted(map(tuple, keyed.membership_join(left, right, "xs", "x").collect())) == [(1, "a", 10), (1, "a", 11)]


def test_messages(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    rows, dead = messages.from_messages(messages.to_messages(df, "id", "t"), "id LONG, v STRING")
    assert sorted((r.topic, r.key, r.id, r.v) for r in rows.collect()) == [("t", "1", 1, "a"), ("t", "2", 2, None)] and dead.count() == 0
    odd = spark.createDataFrame([(None,), ("",), ("[1]",), ('{"id": "x"}',), ('{"id": 3, "more": 1}',)], "value string")
    rows, dead = messages.from_messages(odd, "id LONG, v STRING")
    assert [r.id for r in rows.collect()] == [3] and dead.count() == 4


def test_fusion_and_ties(spark):
    legs = [spark.createDataFrame(rows, "qid long, id long, rank long") for rows in ([(1, 10, 1), (1, 11, 2)], [(1, 11, 1), (1, 12, 2)])]
    got = retrieval.fuse(*legs, k=10)
    assert [(r.id, r.score) for r in got.orderBy("rank").collect()] == [(11, round(1 / 61 + 1 / 62, 6)), (10, round(1 / 61, 6)), (12, round(1 / 62, 6))]
    assert [(r.id, r["rank"]) for r in retrieval.fuse(*reversed(legs), k=10).orderBy("rank").collect()] == [(11, 1), (10, 2), (12, 3)]
    hits = spark.createDataFrame([(1, 1, 0.912, None, 1), (1, 2, 0.909, 0.5, 2), (1, 3, 0.914, 0.1, 3), (1, 4, 0.5, 0.9, 4)], "qid long, id long, score double, pagerank float, rank long")
    assert [r.id for r in retrieval.break_ties(hits, 3).orderBy("place").collect()] == [2, 3, 1]


def test_dense_blocks(spark, monkeypatch):
    rows = [(i, [float(i % 5), float(i % 3), 1.0], i % 2) for i in range(40)] + [(99, None, 0)]
    corpus = spark.createDataFrame(rows, "id long, vector array<float>, g int").repartition(3)
    asked = corpus.where("id % 10 = 0").withColumnRenamed("id", "qid")
    want = {}
    for q, v, g in rows[:40:10]:
        scored = sorted((-round(sum(a * b for a, b in zip(v, w)), 6), i) for i, w, h in rows[:40] if h == g)
        want[q] = [(i, -s) for s, i in scored[:4]]
    for size in (1 << 20, 1):
        monkeypatch.setattr(retrieval, "BLOCK_BYTES", size)
        got = {}
        for r in retrieval.dense_topk(asked, corpus, 4, group="g").orderBy("qid", "rank").collect():
            got.setdefault(r.qid, []).append((r.id, r.score))
        assert got == want
    assert retrieval.dense_topk(asked.limit(0), corpus, 4).count() == 0
