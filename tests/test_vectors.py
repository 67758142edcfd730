"""The vector index against the exact scan, and encoders against plain Python."""

import numpy as np
import pytest

from lodemill.operators import encoders, retrieval, vectors
from lodemill.operators.vectors import VectorIndex
from lodemill.plans import retrieval as plans
from lodemill.session import table


def recall(got, want):
    one, other = ({(r.qid, r.id) for r in df.select("qid", "id").collect()} for df in (got, want))
    return len(one & other) / len(other)


def test_recall_on_the_test_data(spark):
    t = lambda name: table(spark, "/root/testdata/sf0.1", name)
    assert recall(plans.r03_indexed(t), plans.r03(t)) >= 0.9


@pytest.mark.parametrize("kind", ["even", "clusters", "copies"])
def test_recall(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(vectors, "SAMPLE", 700)
    draw = np.random.default_rng(3)
    rows = draw.normal(size=(3000, 24))
    if kind == "clusters":
        rows = draw.normal(size=(30, 24))[draw.integers(0, 30, 3000)] + 0.3 * rows
    if kind == "copies":
        rows[:1000] = rows[0]
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)] + [(9000, None), (None, rows[0].tolist())], "id long, vector array<float>")
    index = VectorIndex.build(df, f"file://{tmp_path}/index")
    assert spark.read.parquet(f"{tmp_path}/index/entries").count() == 3000
    asked = df.where("id % 100 = 0").withColumnRenamed("id", "qid")
    exact = retrieval.dense_topk(asked, df.where("id IS NOT NULL"), 10)
    found = VectorIndex(spark, index.at).search(asked, df, 10)
    assert recall(found, exact) >= 0.9
    scores = {(r.qid, r.id): r.score for r in exact.collect()}
    assert all(abs(scores[r.qid, r.id] - r.score) < 1e-5 for r in found.collect() if (r.qid, r.id) in scores)


def test_empty_index(spark, tmp_path):
    none = spark.createDataFrame([(1, None)], "id long, vector array<float>")
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "qid long, vector array<float>")
    index = VectorIndex.build(none, f"file://{tmp_path}/none")
    assert index.search(asked, none, 3).count() == 0


def test_dense_encoder(spark):
    texts = [(i, f"word{i % 7} and Word{i}") for i in range(40)] + [(100, None), (101, " \n"), (None, "x"), (102, "w " * 600), (103, "w " * 512)]
    got = {r.id: r.vector for r in encoders.encode_dense(spark.createDataFrame(texts, "id long, text string"), encoders.HashedWords).collect()}
    assert sorted(got) == [*range(40), 102, 103]
    model = encoders.HashedWords()
    for i, t in texts[:40]:
        want = model([t])[0]
        assert np.allclose(got[i], want / np.linalg.norm(want), atol=1e-6)
    assert got[102] == got[103] and encoders.cut_words("a b  c", 2) == "a b"


def test_sparse_encoder(spark):
    def make():
        def model(texts):
            sizes = [len(t.split()) for t in texts]
            logits, mask = np.full((len(texts), max(sizes), 5), 9.0), np.zeros((len(texts), max(sizes)))
            for i, t in enumerate(texts):
                for j, w in enumerate(t.split()):
                    logits[i, j] = [(-1) ** k * len(w) * (k + 1) for k in range(5)]
                    mask[i, j] = 1
            return logits, mask

        return model

    got = {(r.id, r.token): r.weight for r in encoders.encode_sparse(spark.createDataFrame([(1, "ab abc"), (2, "a"), (3, None)], "id long, text string"), make).collect()}
    want = {(i, k): np.log1p(n * (k + 1)) for i, n in ((1, 3), (2, 1)) for k in (0, 2, 4)}
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in want)
