"""Connected components of an edge table, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node that each node of an edge is connected with.

    Edges are hooked alternately to the smallest neighbour of either end (large star and small star),
    so a chain halves each round and a hub's edges are never collected: minima are taken before the
    shuffle. Loops and repeated edges do no harm; an empty table gives an empty result.
    """
    now = cut(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo <> hi").distinct())
    for _ in range(ROUNDS):
        # large star: every larger neighbour of a node is tied to the node's smallest neighbour
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        # small star: a node and its smaller neighbours are tied to the smallest of them
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        after = cut(small.unionByName(low.select("hi", F.col("m").alias("lo"))).select("lo", "hi").distinct())
        changed = now.exceptAll(after).unionByName(after.exceptAll(now))
        done = changed.isEmpty()
        now = after
        if done:
            break
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
