"""Keyed tables on plain files: merges, upserts, tombstones, membership joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Of each key the row that is last in order, its other columns breaking ties; one partial row a task and key."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order)], *[F.col(c) for c in rest]))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, *[F.col(f"__b.{c}").alias(c) for c in rest])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new, and those of old whose key is not in new. new must have one row a key."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*old.columns))


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of old, and those of new whose key is not in old, one a key (the least)."""
    fresh = new.join(old.select(*keys), list(keys), "left_anti").select(*old.columns)
    rest = [c for c in old.columns if c not in keys]
    one = fresh.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__b")).select(*keys, *[F.col(f"__b.{c}").alias(c) for c in rest]) if rest else fresh.distinct()
    return old.unionByName(one.select(*old.columns))


def membership_join(left: DataFrame, right: DataFrame, array: str, key: str, how: str = "inner") -> DataFrame:
    """right's rows whose key is an element of left's array, as an equi-join on the exploded array.

    A condition array_contains(array, key) would compare every row with every row. Null arrays, empty
    arrays and null elements meet nothing; a repeated element meets its row once.
    """
    elements = left.withColumn("__e", F.explode(F.array_distinct(array))).drop(array)
    return elements.join(right, F.col("__e") == right[key], how).drop("__e")
