"""References to records that do not exist, direct and inherited."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .skew import lookup, semi_split


class Orphans:
    """direct: references whose name nobody provides. inherited: references to a name whose only
    providers are themselves orphaned, with the round in which that came out. Each is worked out when it
    is asked for, so a caller of direct alone starts no cascade."""

    def __init__(self, refs: DataFrame, pages: DataFrame, aliases: DataFrame) -> None:
        self._refs = refs
        self._pages = pages.select("name").where("name IS NOT NULL").distinct()
        self._aliases = aliases.select("name", "target").where("name IS NOT NULL").distinct()

    @cached_property
    def direct(self) -> DataFrame:
        known = self._pages.unionByName(self._aliases.select("name"))
        return semi_split(self._refs, "name", known, keep_known=False)

    @cached_property
    def inherited(self) -> DataFrame:
        return lookup(self._refs, fallen_aliases(self._pages, self._aliases), "name")

    def report(self) -> DataFrame:
        """table_name, period, kind, n."""
        both = self.direct.withColumn("kind", F.lit("direct")).unionByName(self.inherited.drop("round").withColumn("kind", F.lit("inherited")))
        return both.groupBy("table_name", "period", "kind").agg(F.count(F.lit(1)).alias("n"))


def cascade(refs: DataFrame, pages: DataFrame, aliases: DataFrame) -> Orphans:
    """The fixpoint cascade.

    refs: any columns and name, the key that is referred to. pages: name, provided for good. aliases:
    name and target, a name that is provided as long as its target is. A reference is orphaned directly
    if its name is neither a page's nor an alias's; an alias all of whose targets are orphaned is
    orphaned too, and so are the references to it. Aliases that only lead to each other are provided.
    A null name counts as unknown.
    """
    return Orphans(refs, pages, aliases)


def _chains(single: DataFrame, forks: DataFrame, pages: DataFrame) -> DataFrame:
    """name, end, steps of the aliases with one target: the fork that a chain of them leads to, or a null
    end for an unknown name; chains to pages and circles are left out.

    Pointers double each round, so a chain of n aliases takes log2(n) of them; what is open after that
    many rounds goes round in a circle.
    """
    kinds = single.select(F.col("name").alias("at"), F.lit("open").alias("kind")).unionByName(forks.select(F.col("name").alias("at"), F.lit("fork").alias("kind")))
    kinds = kinds.unionByName(pages.select(F.col("name").alias("at"), F.lit("page").alias("kind")))
    now = cut(
        single.select("name", F.col("target").alias("at"), F.lit(1).alias("steps")).join(kinds, "at", "left")
        .select("name", "at", "steps", F.coalesce("kind", F.lit("lost")).alias("kind")).where("kind <> 'page'")
    )
    reach, total = 1, now.count()
    while reach <= total and not now.where("kind = 'open'").isEmpty():
        further = now.select(F.col("name").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"), F.col("kind").alias("then"))
        jumped = now.where("kind = 'open'").join(further, "at").select("name", F.col("next").alias("at"), (F.col("steps") + F.col("more")).alias("steps"), F.col("then").alias("kind"))
        now = cut(now.where("kind <> 'open'").unionByName(jumped))
        reach *= 2
    return now.where("kind <> 'open'").select("name", F.when(F.col("kind") == "fork", F.col("at")).alias("end"), "steps")


def fallen_aliases(pages: DataFrame, aliases: DataFrame) -> DataFrame:
    """name and round of every alias that leads to nothing but unknown names; round is the longest way there.

    Aliases with one target are walked by doubling (_chains). Those with several, the forks, fall in
    waves: a wave joins the targets of the forks still standing with what fell before, and they end when a
    wave fells nothing, whatever their number.
    """
    weak = cut(aliases.join(pages, "name", "left_anti"))
    needed = weak.groupBy("name").agg(F.count(F.lit(1)).alias("targets"))
    single = weak.join(needed.where("targets = 1"), "name", "left_semi")
    forks = cut(needed.where("targets > 1"))
    chains = _chains(single, forks, pages)
    straight = chains.where("end IS NULL").select("name", F.col("steps").alias("round"))
    if forks.isEmpty():
        return straight
    ends = chains.select(F.col("name").alias("target"), "end", "steps").unionByName(forks.select(F.col("name").alias("target"), F.col("name").alias("end"), F.lit(0).alias("steps")))
    known = pages.unionByName(weak.select("name")).select(F.col("name").alias("target")).distinct()
    targets = weak.join(forks.select("name"), "name", "left_semi")
    led = targets.join(ends, "target").select("name", "end", "steps")
    lost = targets.join(known, "target", "left_anti").select("name", F.lit(None).cast("string").alias("end"), F.lit(0).alias("steps"))
    standing = cut(led.unionByName(lost).join(forks, "name"))
    fallen = standing.where(F.lit(False)).select("name", F.col("steps").alias("round"))
    while True:
        met = standing.join(fallen.select(F.col("name").alias("end"), "round"), "end", "left").where("end IS NULL OR round IS NOT NULL")
        down = met.groupBy("name", "targets").agg(F.count(F.lit(1)).alias("lost"), (F.max(F.col("steps") + F.coalesce("round", F.lit(0))) + 1).alias("round"))
        down = down.where("lost >= targets").select("name", "round").join(fallen.select("name"), "name", "left_anti")
        after = cut(fallen.unionByName(down))
        if after.count() == fallen.count():
            break
        fallen = after
    led_there = chains.where("end IS NOT NULL").join(fallen.select(F.col("name").alias("end"), "round"), "end").select("name", (F.col("steps") + F.col("round")).alias("round"))
    return straight.unionByName(fallen).unionByName(led_there)
