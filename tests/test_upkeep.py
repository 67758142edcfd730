"""Skew, incremental runs, repeated messages and orphans, with nulls, ties, repeats and empty tables."""

import json
import random
from collections import Counter
from datetime import datetime

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodemill.functions.titles import filled, name, page_name
from lodemill.operators import dedup, incremental, orphans, skew


def rows(df):
    return Counter(tuple(r) for r in df.collect())


TITLES = ["a_b", " a  b ", "가", "가", "é", "é", "", " ", " ", "_", "x y", "x　y", "\x1cq", None, "a​b", "A"]


def test_names_equal_python(spark):
    df = spark.createDataFrame([(t,) for t in TITLES], "t string")
    assert [r[0] for r in df.select(name(F.col("t"))).collect()] == [page_name(t) for t in TITLES]
    assert [r[0] for r in df.select(filled(F.col("t"))).collect()] == [bool(t and t.strip()) for t in TITLES]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aé_ ́각가각  \nz", max_size=8), min_size=1, max_size=20))
def test_names_of_any_text(spark, titles):
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert [r[0] for r in df.select(name(F.col("t"))).collect()] == [page_name(t) for t in titles]


COUNT = {"n": (lambda: F.count(F.lit(1)), lambda c: F.sum(c)), "sources": (lambda: F.countDistinct("s"), lambda c: F.sum(c))}


def test_salted_aggregate(spark):
    data = [("hot", i, i % 50) for i in range(900)] + [(f"k{i % 90}", i, i) for i in range(300)] + [(None, 1, 1)] * 40
    df = spark.createDataFrame([(k, i, s, "x", 1) for k, i, s in data], "k string, i int, s int, __salt string, __heavy int")
    got = skew.salted_aggregate(df.drop("__salt", "__heavy"), ["k"], COUNT, salt_on=["s"], heavy_share=0.05, salts=8)
    want = Counter({(k, sum(1 for x in data if x[0] == k), len({x[2] for x in data if x[0] == k})): 1 for k in {x[0] for x in data}})
    assert rows(got) == want
    assert rows(skew.salted_aggregate(df.limit(0).select("k", "i", "s"), ["k"], COUNT, salt_on=["s"])) == Counter()


def test_heavy_keys_are_few(spark):
    df = spark.range(10_000).select((F.col("id") % 100).alias("k"))
    assert skew.heavy_keys(df, ["k"], 0.01).count() == 100
    assert skew.heavy_keys(df, ["k"], 0.011).count() == 0


@pytest.mark.parametrize("keep", [True, False])
def test_semi_split(spark, keep):
    df = spark.createDataFrame([("hot", i) for i in range(500)] + [("cold", 1), ("odd", 2), (None, 3)], "k string, v int")
    allowed = spark.createDataFrame([("hot",), ("odd",), ("odd",), (None,)], "k string")
    got = rows(skew.semi_split(df, "k", allowed, keep_known=keep, heavy_share=0.1).select("k", "v"))
    want = Counter((k, v) for k, v in map(tuple, df.collect()) if (k in ("hot", "odd")) == keep)
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup(spark, how):
    df = spark.createDataFrame([("hot", i) for i in range(500)] + [("warm", i) for i in range(90)] + [("cold", 1), ("odd", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("hot", "x"), ("odd", "y"), ("more", "z"), (None, "n")], "k string, w string")
    assert rows(skew.lookup(df, right, "k", how, heavy_share=0.1).select("k", "v", "w")) == rows(df.join(right, "k", how).select("k", "v", "w"))


def test_message_key(spark):
    same = [("9:00002", "AB"), ("9:2", "ab"), ("9:+2", "aB")]
    other = [("9:2", None), ("09:2", "ab"), ("9:x", "ab"), ("9:20", "ab"), ("9", "ab"), ("9:", "ab"), ("9:2:1", "ab")]
    df = spark.createDataFrame(same + other + [(None, "ab")], "c string, h string")
    keys = [r[0] for r in df.select(dedup.message_key(F.col("c"), F.col("h"))).collect()]
    assert len(set(map(bytes, keys[:3]))) == 1
    assert len(set(map(bytes, keys[:-1]))) == 1 + len(other)
    assert keys[-1] is None


@pytest.mark.parametrize("bytes_at_once", [1 << 20, 1])
def test_copies(spark, tmp_path, monkeypatch, bytes_at_once):
    monkeypatch.setattr(dedup, "BROADCAST_BYTES", bytes_at_once)
    data = [(i, f"d:{i % 7 if i % 3 else 1}", f"payload {i}") for i in range(200)] + [(1000, None, "p"), (1001, None, "q")]
    path = str(tmp_path / "records.parquet")
    spark.createDataFrame(data, "record_id long, chunk_id string, payload string").repartition(5).write.parquet(path)
    vectors = dedup.survivors(spark, path, F.col("chunk_id"), F.col("record_id")).cache()
    best = {}
    for i, c, _ in data:
        if c is not None:
            best[c] = min(i, best.get(c, i))
    stay = {i for i, c, _ in data if c is None or best[c] == i}
    assert {r[0] for r in dedup.apply_vectors(spark, path, vectors, ["record_id", "payload"]).collect()} == stay
    gone = [r[0] for r in dedup.apply_vectors(spark, path, vectors, ["record_id"], kept=False).collect()]
    assert sorted(gone) == sorted({i for i, _, _ in data} - stay)


def test_copies_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none.parquet")
    spark.createDataFrame([], "record_id long, chunk_id string").write.parquet(path)
    vectors = dedup.survivors(spark, path, F.col("chunk_id"), F.col("record_id"))
    assert dedup.apply_vectors(spark, path, vectors, ["record_id"], kept=False).count() == 0


def test_due_records(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"h{i}", 0) for i in range(300)] + [(300, None, 0), (None, "x", 0), (301, "ABC", 0), (302, "r", 1), (302, "r", 2), (303, "s", 1), (303, "t", 2)], "doc_id long, content_hash string, run int")
    early, late, now = datetime(2026, 1, 1), datetime(2026, 3, 1), datetime(2026, 2, 1)
    old = [(i, early, f"H{i}", late) for i in range(250)]
    old[5] = (5, early, "other", early)  # changed and due
    old[6] = (6, early, "other", late)  # changed, not due
    old[7] = (7, early, "other", None)  # changed, no due time
    old[8] = (8, early, None, early)  # no hash
    old += [(9, None, "other", early), (10, late, "other", early), (999, early, "gone", early), (301, early, "abc", early), (None, early, "z", early), (302, early, "r", early)]
    state = spark.createDataFrame(old, "doc_id long, last_fetched timestamp_ntz, last_hash string, next_due_at timestamp_ntz")
    latest = incremental.latest_state(state, "doc_id", "last_fetched", "last_hash", "next_due_at")
    assert latest.count() == 253
    runs = incremental.IncrementalRun(spark, f"file://{tmp_path}/due")
    assert runs.adopt(latest.select(F.col("doc_id").alias("key"), F.lower("last_hash").alias("value"), F.col("next_due_at").alias("due"))) == 1

    def take(at):
        return [r[0] for r in runs.output(runs.run(docs, "doc_id", F.lower("content_hash"), lambda d: d.select("doc_id"), as_of=F.lit(at))).orderBy("doc_id").collect()]

    assert take(now) == [5, 7, 8, 10] + list(range(250, 300)) + [303, 303]
    assert take(now) == []  # what was taken up is saved, what isn't due waits
    assert take(datetime(2026, 4, 1)) == [6]
    assert {r.key for r in runs.saved_records().collect()} == set(range(300)) | {301, 302, 303}
    none = runs.run(docs.limit(0), "doc_id", F.lower("content_hash"), lambda d: d.select("doc_id"))
    assert runs.output(none).count() == 0 and runs.saved_records().count() == 0


def test_only_changed_leaves_differ(spark):
    a = spark.range(5000).select((F.col("id") / 64).cast("long").alias("node"), F.col("id").alias("key"), F.lit("x").alias("value"))
    b = a.withColumn("value", F.when(F.col("key").isin(70, 4000), "y").otherwise(F.col("value"))).where("key <> 1000")
    trees = [incremental.tree_of(d.withColumn("run", F.lit(1).cast("long"))) for d in (a, b)]
    assert sorted(r[0] for r in incremental.changed_leaves(*trees).collect()) == [1, 1000 >> 6, 4000 >> 6]
    assert incremental.changed_leaves(trees[0], trees[0]).count() == 0


def test_runs_survive_failures(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "SPREAD", 2)
    runs = incremental.IncrementalRun(spark, f"file://{tmp_path}/runs")
    first = spark.createDataFrame([(i, f"v{i}") for i in range(200)] + [(900, None)], "k long, v string")
    seen = []

    def take(df):
        seen.append(sorted(r[0] for r in df.select("k").collect()))
        return df

    def fail(df):
        raise RuntimeError("lost")

    assert runs.run(first, "k", F.col("v"), take) == 1
    second = spark.createDataFrame([(i, f"v{i}" if i % 150 else "new") for i in range(205)], "k long, v string")
    with pytest.raises(RuntimeError):
        runs.run(second, "k", F.col("v"), fail)
    assert runs.published() == 1
    assert runs.run(second, "k", F.col("v"), take) == 2
    monkeypatch.setattr(runs, "_publish", lambda *a: fail(a))  # dies before it publishes
    third = second.withColumn("v", F.when(F.col("k") == 20, "newer").otherwise(F.col("v")))
    with pytest.raises(RuntimeError):
        runs.run(third, "k", F.col("v"), take)
    monkeypatch.undo()
    for number in (3, 4):
        assert runs.run(third, "k", F.col("v"), take) == number
    assert seen == [list(range(200)), [0, 150, 200, 201, 202, 203, 204], [20], [20], []]
    assert {(r.key, r.value) for r in runs.saved_records().collect()} == {tuple(r) for r in third.collect()}


def test_a_source_that_moves_during_a_run(spark, tmp_path, monkeypatch):
    """Between digest and processing record 1 changes and record 2 comes: 1 is saved as processed, 2 waits."""
    at = str(tmp_path / "moving.json")

    def put(*rows):
        with open(at, "w") as out:
            json.dump(rows, out)

    def now(frames):
        with open(at) as f:
            yield pd.DataFrame(json.load(f), columns=["k", "v"])

    put((1, "a"))
    source = spark.range(0, 1, 1, 1).mapInPandas(now, "k long, v string")
    runs, leaf = incremental.IncrementalRun(spark, f"file://{tmp_path}/runs"), incremental.cut

    def moved(df):
        done = leaf(df)
        put((1, "b"), (2, "c"))
        return done

    monkeypatch.setattr(incremental, "cut", moved)
    one = runs.run(source, "k", F.col("v"), lambda d: d)
    assert (1, "b") in {tuple(r) for r in runs.output(one).collect()}
    monkeypatch.setattr(incremental, "cut", leaf)
    put((1, "b"), (2, "d"))
    two = runs.run(source, "k", F.col("v"), lambda d: d)
    assert [tuple(r) for r in runs.output(two).collect()] == [(2, "d")]


def test_cascade(spark):
    pages = spark.createDataFrame([("p",), ("q",), ("p",), (None,)], "name string")
    links = [("a", "p"), ("b", "nowhere"), ("c", "b"), ("d", "c"), ("e", "b"), ("e", "p"), ("f", "g"), ("g", "f"), ("q", "nowhere"), ("h", None), ("b", "nowhere"), (None, "p")]
    aliases = spark.createDataFrame(links, "name string, target string")
    refs = spark.createDataFrame([("t", "2026-01", n) for n in ("a", "b", "c", "d", "e", "f", "p", "q", "h", "nowhere", None, "d")], "table_name string, period string, name string")
    found = orphans.cascade(refs, pages, aliases)
    assert rows(found.direct.select("name")) == Counter({("nowhere",): 1, (None,): 1})
    assert {(r.name, r["round"]) for r in found.inherited.collect()} == {("b", 1), ("h", 1), ("c", 2), ("d", 3)}
    assert {tuple(r) for r in found.report().collect()} == {("t", "2026-01", "direct", 2), ("t", "2026-01", "inherited", 5)}
    empty = orphans.cascade(refs.limit(0), pages.limit(0), aliases.limit(0))
    assert empty.direct.count() == 0 and empty.inherited.count() == 0


def test_cascade_follows_any_number_of_redirects(spark):
    chain = [(f"a{k:03}", f"a{k - 1:03}" if k else "nowhere") for k in range(200)] + [("c0", "c1"), ("c1", "c2"), ("c2", "c0"), ("c3", "c2")]
    pages = spark.createDataFrame([("p",)], "name string")
    refs = spark.createDataFrame([("t", "2026-01", n) for n, _ in chain] + [("t", "2026-01", "p")], "table_name string, period string, name string")
    found = orphans.cascade(refs, pages, spark.createDataFrame(chain, "name string, target string"))
    assert sorted((r.name, r["round"]) for r in found.inherited.collect()) == [(f"a{k:03}", k + 1) for k in range(200)]
    assert {tuple(r) for r in found.report().collect()} == {("t", "2026-01", "inherited", 200)}


def test_fallen_aliases_equal_brute_force(spark):
    draw = random.Random(4)
    links, want = [], {}
    for g in range(40):  # forty small graphs in one table
        own = [(f"{g}{draw.choice('abcdefgh')}", draw.choice([None, "p", "x", *(f"{g}{c}" for c in "abcdefgh")])) for _ in range(draw.randrange(14))]
        links += own
        targets = {n: {t for m, t in own if m == n} for n, _ in own if n != f"{g}h"}  # h is a page too
        fallen: dict = {}
        while now := {n: 1 + max(fallen.get(t, 0) for t in ts) for n, ts in targets.items() if n not in fallen and all(t in fallen or t not in targets and t not in ("p", f"{g}h") for t in ts)}:
            fallen |= now
        want |= fallen
    pages = spark.createDataFrame([("p",)] + [(f"{g}h",) for g in range(40)], "name string")
    aliases = spark.createDataFrame(links, "name string, target string").distinct()
    assert want and {r.name: r["round"] for r in orphans.fallen_aliases(pages, aliases).collect()} == want
