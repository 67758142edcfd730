"""Processing only new or changed records, by Merkle trees over key ranges.

A tree has a digest for each range of 2**LEAF_BITS keys (a leaf, level 0) and, LEVELS times over, one for
the leaves below each 2**FAN_BITS nodes. Two trees are compared from the top level down, and only below
nodes that differ. Output and tree of a run are published together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

LEAF_BITS, FAN_BITS, LEVELS = 6, 6, 2
#: Runs over which the saved records may be spread; one more and they are written anew.
SPREAD = 16
TREE = "level int, node long, d1 long, d2 long, n long, run long"
RECORDS = "node long, key long, value string, due timestamp_ntz, run long"


def latest_state(state: DataFrame, key: str, at: str, *values: str) -> DataFrame:
    """One row a key: the values of the row with the greatest at, a null at being the smallest.

    Rows that tie in at are settled by the greatest values, so the result doesn't hang on their order.
    """
    best = state.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(at, *values)).alias("__best"))
    return best.select(key, *[F.col(f"__best.{v}").alias(v) for v in (at, *values)])


def _leaf(key: Column) -> Column:
    return F.shiftright(key.cast("long"), LEAF_BITS).alias("node")


def _digest(*parts: Column) -> list[Column]:
    """An order-free 128-bit digest of rows; nulls as parts leave a row out."""
    there = [p.isNotNull() for p in parts]
    whole = there[0]
    for t in there[1:]:
        whole = whole & t
    hashes = F.xxhash64(*parts), F.xxhash64(F.lit(7), *reversed(parts))
    return [F.coalesce(F.bit_xor(F.when(whole, h)), F.lit(0).cast("long")).alias(d) for h, d in zip(hashes, ("d1", "d2"))] + [F.count_if(whole).alias("n")]


def tree_of(records: DataFrame) -> DataFrame:
    """The whole tree of records (node, key, value, run): level, node, d1, d2, n, of leaves also run."""
    return _with_levels(records.groupBy("node").agg(*_digest(F.col("key"), F.col("value")), F.max("run").alias("run")))


def _with_levels(leaves: DataFrame) -> DataFrame:
    held = leaves.select(F.explode(F.sequence(F.lit(1), F.lit(LEVELS))).alias("level"), "node", "d1", "d2", "n")
    above = held.groupBy("level", F.expr(f"shiftright(node, {FAN_BITS} * level)").alias("node")).agg(*_digest(*[F.col(f"{c}") for c in ("node", "d1", "d2", "n")]))
    return leaves.select(F.lit(0).alias("level"), "node", "d1", "d2", "n", "run").unionByName(above.withColumn("run", F.lit(None).cast("long")))


def changed_leaves(current: DataFrame, saved: DataFrame) -> DataFrame:
    """node of each leaf whose digest differs or that only one tree has.

    Of every level only the children of nodes that differ are compared.
    """
    both = current.drop("run").unionByName(saved.drop("run"))
    differing: DataFrame | None = None
    for level in range(LEVELS, -1, -1):
        nodes = both.where(F.col("level") == level)
        if differing is not None:
            nodes = nodes.join(differing.withColumnRenamed("node", "up"), F.shiftright("node", FAN_BITS) == F.col("up"), "left_semi")
        sides = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("sides"), *[f(c).alias(f"{k}{c}") for c in ("d1", "d2", "n") for k, f in (("lo", F.min), ("hi", F.max))])
        differing = sides.where("NOT (sides = 2 AND lod1 = hid1 AND lod2 = hid2 AND lon = hin)").select("node")
    return differing


class IncrementalRun:
    """Runs that each take up the records that are new or changed since the last one, and due.

    Below root, run-<number>/ holds a run's output, the records of the leaves that it wrote and the tree over
    all saved records. A run is published by renaming one small file to CURRENT-<number>-<first>, where
    first is the oldest run whose records are still in use; the greatest number holds. A run that dies
    before that leaves nothing that a later one reads, and a run that is repeated finds the same saved tree,
    so no record is skipped or processed twice. What is saved of the records that are processed is what was
    then read of them, so a source that moves during a run loses nothing: what came later differs in the next.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.root))

    def _current(self) -> tuple[int, int] | None:
        names = [s.getPath().getName().split("-") for s in self._fs.listStatus(self._path(self.root))]
        return max(((int(n[1]), int(n[2])) for n in names if n[0] == "CURRENT"), default=None)

    def published(self) -> int | None:
        """Number of the last run that was published."""
        now = self._current()
        return now and now[0]

    def output(self, run: int) -> DataFrame:
        """What the published run made of its records."""
        return self.spark.read.parquet(f"{self.root}/run-{run}/output")

    def saved_tree(self) -> DataFrame:
        run = self.published()
        return self.spark.createDataFrame([], TREE) if run is None else self.spark.read.schema(TREE).parquet(f"{self.root}/run-{run}/tree")

    def saved_records(self) -> DataFrame:
        """node, key, value, due, run of all records as the last run left them."""
        now = self._current()
        if now is None:
            return self.spark.createDataFrame([], RECORDS)
        held = self.spark.read.schema(RECORDS).parquet(*[f"{self.root}/run-{r}/records" for r in range(now[1], now[0] + 1)])
        return held if now[0] == now[1] else held.join(self.saved_tree().where("level = 0").select("node", "run"), ["node", "run"], "left_semi")

    def adopt(self, state: DataFrame) -> int:
        """Publishes state (key, value, due; one row a key) as what earlier runs have processed, without output."""
        number = self._begin()
        kept = state.where("key IS NOT NULL").select(_leaf(F.col("key")), F.col("key").cast("long"), "value", F.col("due").cast("timestamp_ntz"))
        return self._publish(number, number, kept, None)

    def run(
        self, current: DataFrame, key: str, value: Column, process: Callable[[DataFrame], DataFrame], *, as_of: Column | None = None, next_due: Column | None = None
    ) -> int:
        """Hands the records of current that are to be taken up to process, publishes what it returns; gives
        the run's number.

        A record with a null key or value is never taken up. One whose key is not saved is new and taken up;
        else it is if the saved value is null or differs and, where as_of is given, the saved due time is null
        or not after as_of; one that isn't due stays as it was saved, so a later run finds it changed still. A
        repeated key counts with its greatest value and is handed on with all its rows. Keys that current no
        longer has are dropped from the saved records of the leaves that the run writes. next_due: a column of
        current that is saved as the due time of what is processed, else null.
        """
        last, number = self._current(), self._begin()
        at = f"{self.root}/run-{number}"
        whole = current.where(F.col(key).isNotNull() & value.isNotNull())
        narrow = whole.select(_leaf(F.col(key)), F.col(key).cast("long").alias("key"), value.alias("value"))
        nodes = cut(changed_leaves(tree_of(narrow.withColumn("run", F.lit(None).cast("long"))), self.saved_tree()))

        now = narrow.join(nodes, "node", "left_semi").groupBy("key").agg(F.max("value").alias("now"))
        known = self.saved_records().join(nodes, "node", "left_semi").select("key", "value", "due", F.lit(True).alias("known"))
        differs = F.col("value").isNull() | (F.col("value") != F.col("now"))
        ready = F.lit(True) if as_of is None else F.col("due").isNull() | (F.col("due") <= as_of)
        here = cut(now.join(known, "key", "left").select("key", "value", "due", "known", (F.col("known").isNull() | (differs & ready)).alias("take")))
        due = F.lit(None).cast("timestamp_ntz") if next_due is None else next_due.cast("timestamp_ntz")
        taken = whole.withColumns({"__value": value, "__due": due}).join(here.where("take").select(F.col("key").alias("__key")), F.col(key).cast("long") == F.col("__key"), "left_semi")
        taken.write.parquet(f"{at}/input")
        taken = self.spark.read.schema(taken.schema).parquet(f"{at}/input")
        process(taken.drop("__value", "__due")).write.parquet(f"{at}/output")

        done = taken.groupBy(F.col(key).cast("long").alias("key")).agg(F.max(F.struct(F.col("__value").alias("value"), F.col("__due").alias("due"))).alias("b")).select("key", "b.*")
        stay = here.where("known").join(done.select("key"), "key", "left_anti").select("key", "value", "due")
        kept = stay.unionByName(done).select(_leaf(F.col("key")), "key", "value", "due")
        if last is not None and number - last[1] > SPREAD:
            others = self.saved_records().join(nodes, "node", "left_anti").select("node", "key", "value", "due")
            return self._publish(number, number, kept.unionByName(others), None)
        rest = self.saved_tree().where("level = 0").join(nodes, "node", "left_anti").drop("level")
        return self._publish(number, number if last is None else last[1], kept, rest)

    def _begin(self) -> int:
        last = self.published()
        number = 1 if last is None else last + 1
        self._fs.delete(self._path(f"{self.root}/run-{number}"), True)  # left by a run that failed
        return number

    def _publish(self, number: int, first: int, records: DataFrame, rest: DataFrame | None) -> int:
        """Writes records and the tree over them and the leaves of rest, which earlier runs wrote, and makes them hold."""
        at = f"{self.root}/run-{number}"
        records.withColumn("run", F.lit(number).cast("long")).write.parquet(f"{at}/records")
        tree = tree_of(self.spark.read.schema(RECORDS).parquet(f"{at}/records"))
        if rest is not None:
            tree = _with_levels(tree.where("level = 0").drop("level").unionByName(rest))
        tree.write.parquet(f"{at}/tree")
        self._fs.delete(self._path(f"{at}/input"), True)
        self._fs.create(self._path(f"{at}/done"), True).close()
        if not self._fs.rename(self._path(f"{at}/done"), self._path(f"{self.root}/CURRENT-{number}-{first}")):
            raise RuntimeError(f"run {number} could not be published")
        return number
