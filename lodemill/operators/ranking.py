"""Ranks over a whole table without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """df with its 1-based rank in the given order, which must be total for the ranks to be fixed.

    Rows are range-partitioned and sorted; a row's rank is its place in its partition plus the number of
    rows in the partitions before, of which there are as many as partitions. An empty table stays empty.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # written once, since the ranges come from a sample that a second evaluation would draw anew
    placed = cut(placed.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).select("__part", "__before")
    return placed.join(F.broadcast(before), "__part").withColumn(name, F.col("__at") + F.col("__before") + 1).drop("__part", "__at", "__before")


def tile(rank: Column, total: Column, tiles: int) -> Column:
    """The ntile of a rank: tiles differ by one row at most, larger ones first."""
    base, more = F.floor(total / tiles), total % tiles
    return F.when(rank <= more * (base + 1), F.floor((rank - 1) / (base + 1)) + 1).otherwise(more + F.floor((rank - 1 - more * (base + 1)) / F.greatest(base, F.lit(1))) + 1)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each group with their rank; tasks drop all but their own first k before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window).cast("long")).where(F.col(name) <= k)
