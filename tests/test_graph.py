"""Graph operators against plain Python."""

import random
from collections import Counter, defaultdict, deque

import pytest

from lodemill.operators import graph
from lodemill.operators.components import components


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_resolve(spark):
    nodes = table(spark, [(1, "a"), (2, "b"), (3, "편집 요청"), (4, None)], "id long, title string")
    aliases = table(spark, [("x", "a"), ("b", "a"), ("y", "x"), ("c", "편집 요청")], "alias string, canonical string")
    links = table(spark, [(1, "a"), (1, "a"), (1, "x"), (2, "b"), (2, "y"), (2, "nobody"), (3, "a"), (1, "편집 요청"), (1, "c"), (1, None)], "src long, title string")
    got = Counter(map(tuple, graph.resolve(links, nodes, aliases, ("편집 요청",)).collect()))
    assert got == Counter({(1, 1): 3, (2, 2): 1, (3, 1): 1})


def plain_pagerank(nodes, edges, rounds, d=0.85):
    n = len(nodes)
    out = Counter(s for s, _ in edges)
    rank = {v: 1 / n for v in nodes}
    for _ in range(rounds):
        lost = sum(rank[v] for v in nodes if not out[v])
        new = {v: (1 - d) / n + d * lost / n for v in nodes}
        for s, t in edges:
            new[t] += d * rank[s] / out[s]
        rank = new
    total = sum(rank.values())
    return {v: r / total for v, r in rank.items()}


@pytest.mark.parametrize("rounds", [1, 4, 7, 60])
def test_pagerank(spark, rounds):
    chooser = random.Random(2)
    nodes = list(range(30))
    edges = [(chooser.randrange(22), chooser.randrange(30)) for _ in range(120)] + [(5, 5), (1, 2), (1, 2)]
    got = {r.id: r["rank"] for r in graph.pagerank(table(spark, [(v,) for v in nodes], "id long"), table(spark, edges, "src long, dst long"), rounds=rounds, tolerance=1e-12).collect()}
    want = plain_pagerank(nodes, edges, rounds)
    assert got.keys() == want.keys() and abs(sum(got.values()) - 1) < 1e-9
    assert all(abs(got[v] - want[v]) < 1e-9 for v in nodes)
    assert graph.pagerank(table(spark, [], "id long"), table(spark, [], "src long, dst long")).count() == 0


def breadth_first(pairs, source):
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b), near[b].add(a)
    far, todo = {source: 0}, deque([source])
    while todo:
        u = todo.popleft()
        for v in near[u]:
            if v not in far:
                far[v] = far[u] + 1
                todo.append(v)
    return far


def test_paths(spark):
    chooser = random.Random(8)
    pairs = sorted({tuple(sorted(chooser.sample(range(60), 2))) for _ in range(70)})
    ends = [(chooser.randrange(60), chooser.randrange(60)) for _ in range(40)] + [(3, 3)]
    for hops in (1, 4, 5):
        got = {(r.source, r.target): r for r in graph.paths(table(spark, pairs, "a long, b long"), table(spark, ends, "source long, target long"), hops).collect()}
        want = {(s, t): d for s, t in ends if (d := breadth_first(pairs, s).get(t)) is not None and d <= hops}
        assert {k: r.hops for k, r in got.items()} == want
        for (s, t), r in got.items():
            assert r.path[0] == s and r.path[-1] == t and len(r.path) == r.hops + 1
            assert all(tuple(sorted(step)) in set(pairs) for step in zip(r.path, r.path[1:]))


def test_components(spark):
    chooser = random.Random(5)
    edges = [(chooser.randrange(300), chooser.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 470)] + [(500, k) for k in range(501, 560)] + [(7, 7), (600, 600)]
    got = {r.node: r.root for r in components(table(spark, edges, "a long, b long")).collect()}
    linked = [e for e in edges if e[0] != e[1]]
    assert got == {v: min(breadth_first(linked, v)) for e in linked for v in e}
    assert components(table(spark, [], "a long, b long")).count() == 0


def test_communities_and_modularity(spark):
    blocks = [range(k * 10, k * 10 + 10) for k in range(4)]
    pairs = [(a, b) for block in blocks for a in block for b in block if a < b] + [(9, 10), (19, 20), (29, 30), (90, 91)]
    df = table(spark, pairs, "a long, b long")
    labels = graph.communities(df)
    got = {r.node: r.community for r in labels.collect()}
    assert got[90] is None and got[91] is None
    assert all(len({got[v] for v in block}) == 1 for block in blocks) and len({got[v] for v in range(40)}) == 4
    q = sum(r.part for r in graph.modularity(df, labels.where("community IS NOT NULL")).collect())
    assert q > 0.7
    whole = labels.selectExpr("node", "1L AS community")
    assert abs(sum(r.part for r in graph.modularity(df, whole).collect())) < 1e-9


def test_expand_takes_any_seed_back(spark):
    edges = table(spark, [("a", "x"), ("x", "b"), ("a", "y"), ("b", "x"), ("a", "b"), ("y", "z"), ("x", "x")], "src string, dst string")
    seeds = table(spark, [(1, "a"), (1, "b")], "qid long, node string")
    assert [(r.node, r.shared, r["rank"]) for r in graph.expand(edges, seeds, 5).collect()] == [("x", 2, 1)]


@pytest.mark.parametrize("rounds", [1, 12])
def test_communities_settle(spark, rounds):
    chooser = random.Random(9)
    pairs = sorted({tuple(sorted(chooser.sample(range(150), 2))) for _ in range(260)} | {(k, k + 1) for k in range(150, 210)})
    labels = {r.node: r.community for r in graph.communities(table(spark, pairs, "a long, b long"), rounds=rounds, least=1).collect()}
    near = defaultdict(list)
    for a, b in pairs:
        near[a].append(b), near[b].append(a)
    for node, label in labels.items():
        votes = Counter([label, *(labels[v] for v in near[node])])
        assert label == min(votes, key=lambda x: (-votes[x], x))


def test_communities_leave_no_growing_estimates(spark):
    """Each round joins the outcome of the one before twice: the planner's estimate of the size once was a number whose
    digits doubled with each, until the driver's memory was full."""
    chooser = random.Random(9)
    pairs = sorted({tuple(sorted(chooser.sample(range(150), 2))) for _ in range(260)} | {(k, k + 1) for k in range(150, 210)})
    labels = graph.communities(table(spark, pairs, "a long, b long"), rounds=1, least=1)
    assert labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2**100


def test_communities_of_hubs_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(graph, "PIECE", 3)
    pairs = [(0, k) for k in range(1, 40)] + [(100, k) for k in range(101, 140)]
    labels = {r.node: r.community for r in graph.communities(table(spark, pairs, "a long, b long")).collect()}
    assert labels == {v: v // 100 * 100 for pair in pairs for v in pair}
    assert graph.communities(table(spark, [], "a long, b long")).count() == 0
