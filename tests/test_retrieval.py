"""Sparse retrieval by all tokens against plain Python."""

from collections import Counter, defaultdict

from lodemill.operators import retrieval
from lodemill.plans import retrieval as plans


def test_sparse_scan(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "BLOCK_BYTES", 900)  # several blocks of questions and of scores
    texts = {k: " ".join([f"rare{chr(97 + k // 26)}{chr(97 + k % 26)}{chr(97 + j)}" for j in range(12)] + ["the"] * (k % 5 + 1) + ["house"] * (k % 3)) for k in range(60)}
    texts[7], texts[8], texts[9] = None, "", "the the"
    df = spark.createDataFrame(list(texts.items()), "id long, text string").repartition(3)
    counts = {k: Counter((v or "").split()) for k, v in texts.items()}
    weight = lambda token: 0.25 if token == "the" else 1.5
    terms = [(q, token, weight(token)) for q in (0, 10, 20) for token in counts[q]]
    want = defaultdict(list)
    for q in (0, 10, 20):
        for k, held in counts.items():
            if score := round(sum(weight(token) * held[token] for token in counts[q]), 6):
                want[q].append((-score, k))
    ordered = {q: [(k, -s) for s, k in sorted(rows)] for q, rows in want.items()}
    asked, words = spark.createDataFrame(terms, "qid long, token string, weight double"), retrieval.word_lists(df)
    got = defaultdict(list)
    for r in sorted(retrieval.sparse_scan(asked, words, 20).collect(), key=lambda r: (r.qid, r["rank"])):
        got[r.qid].append((r.id, r.score))
    assert dict(got) == {q: rows[:20] for q, rows in ordered.items()} and all(len(rows) == 20 for rows in got.values())
    ranks = {r.qid: r["rank"] for r in retrieval.sparse_gold_ranks(asked, words).collect()}
    assert ranks == {q: [k for k, _ in rows].index(q) + 1 for q, rows in ordered.items()}


def test_expansion_searches_the_neighbours_again(spark):
    """Page 250 is linked with page 0 both ways, but far from it in words and vectors; so is 251, one way."""
    links = {0: ["P250", "P251"], 250: ["P0"]}
    docs = [(k, f"P{k}", "other" if k >= 250 else f"word {'x' * k}", links.get(k, [])) for k in range(260)]
    tables = {
        "documents": spark.createDataFrame(docs, "doc_id long, title string, text string, outlinks array<string>"),
        "embeddings": spark.createDataFrame([(k, [1.0, -float(k)], 0) for k in range(260)], "vec_id long, embedding array<float>, label int"),
        "redirects": spark.createDataFrame([], "alias string, canonical string"),
    }
    rows = {r.id: r["rank"] for r in plans.r09(tables.__getitem__).where("qid = 0").collect()}
    assert rows[250] == 21 and 251 not in rows and sorted(rows.values()) == list(range(1, 22))
