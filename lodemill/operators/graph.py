"""Graphs as edge tables: building, PageRank, paths, communities, neighbourhoods."""

from __future__ import annotations

import uuid
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, drop, keep, shared_dir
from .skew import lookup

#: Rounds between two lineage cuts of an iteration.
EVERY = 4
#: Neighbours in one row of a table of neighbours, about; a hub has several rows.
PIECE = 1024


def resolve(links: DataFrame, nodes: DataFrame, aliases: DataFrame, chrome: tuple[str, ...] = ()) -> DataFrame:
    """src, dst: links (src, title) whose title is a node's (id, title), else an alias (alias, canonical) of one.

    A title that is both is the node. Repeated links stay, also those by alias and by title; loops stay;
    links to chrome titles and to titles that nobody has are dropped. aliases must have one row an alias.
    Links to a page that very many link to meet a broadcast of such pages, the others a shuffle.
    """
    usable = nodes.where(~F.col("title").isin(*chrome)) if chrome else nodes
    usable = usable.where("title IS NOT NULL").select(F.col("id").alias("dst"), "title")
    by_alias = aliases.join(usable, F.col("canonical") == F.col("title")).select(F.col("alias").alias("title"), "dst").join(nodes.select("title"), "title", "left_anti")
    return lookup(links, usable.unionByName(by_alias.select("dst", "title")), "title").select("src", "dst")


def pagerank(nodes: DataFrame, edges: DataFrame, *, damping: float = 0.85, rounds: int = 30, tolerance: float = 1e-8) -> DataFrame:
    """id, rank of every node; the ranks sum to 1.

    A node gives its rank to its out-edges in equal parts, repeats counted; the rank of nodes without
    out-edges goes to all nodes alike. Iteration ends when the ranks change by less than tolerance in
    sum, or after that many rounds. Edges are weighed and partitioned by source once; a round shuffles
    one partial sum a task and target. No nodes give an empty result.
    """
    count = nodes.count()
    if not count:
        return nodes.select("id", F.lit(0.0).alias("rank"))
    degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    # repeats of an edge become its weight
    weighed = cut(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m")).join(degree, "src").select("src", "dst", (F.col("m") / F.col("degree")).alias("w")))
    base = cut(nodes.select("id").join(degree.select(F.col("src").alias("id"), F.lit(True).alias("out")), "id", "left").select("id", F.col("out").isNull().alias("dangling")))
    ranks = base.select("id", "dangling", F.lit(1.0 / count).alias("rank"))
    for number in range(rounds):
        lost = ranks.where("dangling").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("lost")).withColumn("one", F.lit(1))
        given = weighed.join(ranks.select(F.col("id").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("w")).alias("got"))
        new = ranks.withColumn("one", F.lit(1)).join(F.broadcast(lost), "one").join(given, "id", "left").select(
            "id", "dangling", F.col("rank").alias("old"),
            (F.lit((1 - damping) / count) + F.lit(damping) * F.col("lost") / count + F.lit(damping) * F.coalesce("got", F.lit(0.0))).alias("rank"),
        )
        if number % EVERY == EVERY - 1 or number == rounds - 1:
            new = cut(new)
            change = new.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]  # one number
            if change < tolerance:
                ranks = new
                break
        ranks = new.select("id", "dangling", "rank")
    total = ranks.agg(F.sum("rank").alias("total")).withColumn("one", F.lit(1))
    return ranks.withColumn("one", F.lit(1)).join(F.broadcast(total), "one").select("id", (F.col("rank") / F.col("total")).alias("rank"))


def undirected(edges: DataFrame) -> DataFrame:
    """a, b with a < b: loops dropped, repeats and directions collapsed."""
    return edges.where("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()


def communities(pairs: DataFrame, *, rounds: int = 12, least: int = 5) -> DataFrame:
    """node, community by label propagation over undirected pairs (a, b); null in communities below least.

    Each round a node takes the label most frequent among its neighbours and itself, of equally frequent
    ones the least; in odd rounds only nodes of odd hash move, in even rounds the others. Two sides of one
    half may still swap labels for ever, so after that many rounds only nodes move that come before all
    their neighbours that want to. Each such move makes more pairs agree, so it ends, and only when no node
    wants to move. A hub's neighbours are counted by label before the shuffle. The outcome is fixed by the
    edges; it is not that of a modularity search. Neighbours lie in arrays, as each round shuffles them; the
    rounds' tables are dropped as soon as the next is written.
    """
    spark = pairs.sparkSession
    at = f"{shared_dir(spark)}/communities-{uuid.uuid4().hex}"
    try:
        labels = _settled(pairs, rounds, at)
        sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
        return cut(labels.join(sizes, "label").select("node", F.when(F.col("size") >= least, F.col("label")).alias("community")))
    finally:
        drop(spark, at)


def _settled(pairs: DataFrame, rounds: int, at: str) -> DataFrame:
    """node, label when no node wants to move; tables are kept in the folder at."""
    spark = pairs.sparkSession
    ends = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    both = keep(pairs.select(ends.alias("e")).select("e.*"), f"{at}/both")
    degree = both.groupBy("v").agg(F.count(F.lit(1)).alias("degree"))
    piece = F.pmod(F.xxhash64("u"), F.ceil(F.col("degree") / PIECE))
    near = keep(both.join(degree, "v").groupBy("v", piece.alias("piece")).agg(F.collect_list("u").alias("near")).select("v", "near"), f"{at}/near")
    labels = keep(near.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node")), f"{at}/labels")
    drop(spark, f"{at}/both")
    for number in count():
        heard = near.join(labels.withColumnRenamed("node", "v"), "v").select(F.explode("near").alias("node"), "label", F.lit(False).alias("own"))
        counted = heard.unionByName(labels.select("node", "label", F.lit(True).alias("own"))).groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("own"))
        best = counted.groupBy("node").agg(F.max(F.when(F.col("own"), F.col("label"))).alias("label"), F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("b"))
        wanted = keep(best.select("node", "label", F.col("b.label").alias("new")), f"{at}/wanted-{number}")
        wants = F.col("label") != F.col("new")
        if wanted.where(wants).isEmpty():
            return wanted.select("node", "label")
        if number < rounds:
            turn = F.pmod(F.xxhash64("node"), F.lit(2)) == number % 2
            labels = wanted.select("node", F.when(turn, F.col("new")).otherwise(F.col("label")).alias("label"))
        else:
            place = F.struct(F.xxhash64("node", F.lit(number)).alias("hash"), "node")
            told = near.join(wanted.where(wants).select(F.col("node").alias("v"), place.alias("place")), "v").select(F.explode("near").alias("node"), "v", "place")
            first = told.where("node <> v").groupBy("node").agg(F.min("place").alias("first"))
            moves = wants & (F.col("first").isNull() | (place < F.col("first")))
            labels = keep(wanted.join(first, "node", "left").select("node", F.when(moves, F.col("new")).otherwise(F.col("label")).alias("label")), f"{at}/labels-{number}")
        if number:
            drop(spark, f"{at}/wanted-{number - 1}")
            drop(spark, f"{at}/labels-{number - 1}")


def modularity(pairs: DataFrame, labels: DataFrame, resolution: float = 1.0) -> DataFrame:
    """community, inside, degree, part of each community; the parts sum to the modularity of the partition.

    pairs: undirected (a, b); labels: node, community. Nodes without a community take part in no term.
    """
    la, lb = (labels.select(F.col("node").alias(n), F.col("community").alias(f"c{n}")) for n in "ab")
    named = pairs.join(la, "a", "left").join(lb, "b", "left")
    inside = named.where("ca = cb").groupBy(F.col("ca").alias("community")).agg(F.count(F.lit(1)).alias("inside"))
    ends = named.select(F.col("ca").alias("community")).unionByName(named.select(F.col("cb").alias("community"))).where("community IS NOT NULL")
    degree = ends.groupBy("community").agg(F.count(F.lit(1)).alias("degree"))
    m = pairs.agg(F.count(F.lit(1)).alias("m")).withColumn("one", F.lit(1))
    part = F.col("inside") / F.col("m") - F.lit(resolution) * (F.col("degree") / (2 * F.col("m"))) * (F.col("degree") / (2 * F.col("m")))
    return (
        degree.join(inside, "community", "left").withColumn("inside", F.coalesce("inside", F.lit(0))).withColumn("one", F.lit(1)).join(F.broadcast(m), "one")
        .select("community", "inside", "degree", part.alias("part"))
    )


def distances(pairs: DataFrame, sources: DataFrame, hops: int) -> DataFrame:
    """source, node, hops, via: every node within that many undirected steps of each source, its distance
    and the least neighbour one step nearer (null for the source itself).

    One frontier join a hop over all sources together; nodes that a source has reached are left out of
    its next frontier.
    """
    both = cut(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))))
    kind = both.schema["u"].dataType
    reached = sources.select(F.col("node").cast(kind).alias("source"), F.col("node").cast(kind).alias("node"), F.lit(0).alias("hops"), F.lit(None).cast(kind).alias("via"))
    frontier = reached
    for hop in range(1, hops + 1):
        step = frontier.select("source", F.col("node").alias("u")).join(both, "u").groupBy("source", F.col("v").alias("node")).agg(F.min("u").alias("via"))
        frontier = cut(step.join(reached, ["source", "node"], "left_anti").select("source", "node", F.lit(hop).alias("hops"), "via"))
        reached = reached.unionByName(frontier)
    return reached


def paths(pairs: DataFrame, ends: DataFrame, hops: int) -> DataFrame:
    """source, target, hops, path: a shortest undirected path of each pair of ends, if one has at most that many steps.

    Both sides grow half of the steps and meet; of several meeting nodes the one with the shortest sum,
    then the least is taken, and each half follows its least nearer neighbours, so the path is fixed.
    """
    ends = ends.select("source", "target").distinct()
    sides = ends.select(F.col("source").alias("node")).unionByName(ends.select(F.col("target").alias("node"))).distinct()
    near = cut(distances(pairs, sides, (hops + 1) // 2))
    out, back = (near.select(F.col("source").alias(end), F.col("node").alias("mid"), F.col("hops").alias(h)) for end, h in (("source", "sh"), ("target", "th")))
    met = ends.join(out, "source").join(back, ["target", "mid"]).withColumn("hops", F.col("sh") + F.col("th")).where(F.col("hops") <= hops)
    best = met.groupBy("source", "target").agg(F.min(F.struct("hops", "mid", "sh", "th")).alias("b")).select("source", "target", "b.*")
    walked = best.withColumns({"left": F.array("mid"), "right": F.array().cast(f"array<{near.schema['node'].dataType.simpleString()}>"), "l": F.col("mid"), "r": F.col("mid")})
    step = near.select(F.col("source").alias("e"), F.col("node").alias("n"), F.col("via").alias("p"))
    for _ in range((hops + 1) // 2):
        walked = walked.join(step, (F.col("source") == F.col("e")) & (F.col("l") == F.col("n")), "left").withColumns(
            {"left": F.when(F.col("p").isNotNull(), F.concat(F.array("p"), "left")).otherwise(F.col("left")), "l": F.coalesce("p", "l")}
        ).drop("e", "n", "p")
        walked = walked.join(step, (F.col("target") == F.col("e")) & (F.col("r") == F.col("n")), "left").withColumns(
            {"right": F.when(F.col("p").isNotNull(), F.concat("right", F.array("p"))).otherwise(F.col("right")), "r": F.coalesce("p", "r")}
        ).drop("e", "n", "p")
    return walked.select("source", "target", "hops", F.concat("left", "right").alias("path"))


def expand(edges: DataFrame, seeds: DataFrame, limit: int) -> DataFrame:
    """qid, node, shared, rank: of each question the nodes that its seeds (qid, node) link to and that link
    back to any of its seeds, themselves no seeds; first those that most seeds link to, then the least."""
    from .ranking import top_per_group

    once = edges.distinct()
    out = seeds.join(once, F.col("node") == F.col("src")).select("qid", F.col("src").alias("seed"), F.col("dst").alias("node"))
    back = seeds.join(once, F.col("node") == F.col("dst")).select("qid", F.col("src").alias("node")).distinct()
    fresh = out.join(seeds.select("qid", "node"), ["qid", "node"], "left_anti").join(back, ["qid", "node"], "left_semi")
    shared = fresh.groupBy("qid", "node").agg(F.count(F.lit(1)).alias("shared"))
    return top_per_group(shared, ["qid"], [F.desc("shared"), F.col("node")], limit)
