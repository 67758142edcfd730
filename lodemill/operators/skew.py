"""Per-key aggregation when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__salt"
HEAVY_SHARE = 0.005
SALTS = 64
#: Heavy keys are looked for in one row of so many. This only balances the work: every row is aggregated, salted or not.
ONE_IN = 16


def key_shares(df: DataFrame, keys: Sequence[str], count: Column | None = None) -> DataFrame:
    """keys, n and share of all rows. Partial counts are made before the shuffle."""
    counted = df.groupBy(*keys).agg((F.count(F.lit(1)) if count is None else F.sum(count)).alias("__n"))
    total = counted.agg(F.sum("__n").alias("__total")).withColumn("__one", F.lit(1))
    return (
        counted.withColumn("__one", F.lit(1))
        .join(F.broadcast(total), "__one")
        .select(*keys, "__n", (F.col("__n") / F.col("__total")).alias("__share"))
    )


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE) -> DataFrame:
    """Keys with at least that share of all rows: never more than 1/share of them, so safe to broadcast."""
    return key_shares(df, keys).where(F.col("__share") >= share).select(*keys)


def salted_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    aggs: dict[str, tuple[Callable[[], Column], Callable[[Column], Column]]],
    *,
    salt_on: Sequence[str],
    heavy: DataFrame | None = None,
    heavy_share: float = HEAVY_SHARE,
    salts: int = SALTS,
    one_in: int = ONE_IN,
) -> DataFrame:
    """Two-stage salted aggregation: keys and one column per entry of aggs.

    aggs: name -> (partial per key and salt, merge of those partials). heavy: keys that are taken to be
    heavy, at most 1/heavy_share; else those that hold that share of one row in one_in. Rows of heavy keys
    get a salt 0..salts-1, all others 0. The salt is a hash of salt_on, so a task that runs again gives a row the
    same salt and no row is lost or counted twice. A partial that counts distinct values of salt_on
    columns may be merged by a sum, since equal values share a salt.

    Null keys form a group of their own. An empty df gives an empty result. Columns of df that are
    named neither in keys nor in aggs play no part, whatever their names.
    """
    if heavy is None:
        heavy = heavy_keys(df.where(F.pmod(F.xxhash64(*[df[c] for c in salt_on]), F.lit(one_in)) == 0), keys, heavy_share)
    # <=> keeps null keys; the heavy side has at most 1/heavy_share rows
    heavy = heavy.select(*[F.col(k).alias(f"__h_{k}") for k in keys], F.lit(True).alias("__heavy"))
    on = None
    for k in keys:
        test = df[k].eqNullSafe(heavy[f"__h_{k}"])
        on = test if on is None else on & test
    salted = df.join(F.broadcast(heavy), on, "left").withColumn(
        SALT,
        F.when(F.col("__heavy"), F.pmod(F.xxhash64(*[df[c] for c in salt_on]), F.lit(salts))).otherwise(F.lit(0)).cast("int"),
    )
    keyed = [df[k] for k in keys]
    partial = salted.groupBy(*keyed, SALT).agg(*[make().alias(n) for n, (make, _) in aggs.items()])
    return partial.groupBy(*keys).agg(*[merge(F.col(n)).alias(n) for n, (_, merge) in aggs.items()])


def semi_split(df: DataFrame, key: str, allowed: DataFrame, *, keep_known: bool, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """Rows of df whose key is (keep_known) or is not in allowed.key, safe when one key holds most rows.

    Rows of heavy keys meet a broadcast of the heavy keys that are allowed, at most 1/heavy_share rows;
    only the rest is shuffled by key. A null key is never in allowed.
    """
    how = "left_semi" if keep_known else "left_anti"
    allowed = allowed.select(F.col(key)).distinct()
    heavy = heavy_keys(df.where(F.col(key).isNotNull()), [key], heavy_share)
    light = df.join(F.broadcast(heavy), key, "left_anti").join(allowed, key, how)
    hot = df.join(F.broadcast(heavy.join(allowed, key, how)), key, "left_semi")
    return light.unionByName(hot)


def lookup(df: DataFrame, right: DataFrame, key: str, how: str = "inner", *, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """df joined (inner or left) with right, which has at most one row a key, safe when one key holds most of df.

    Rows of heavy keys meet a broadcast of right's rows of those keys, at most 1/heavy_share; only the rest
    is shuffled by key. A null key meets nothing.
    """
    heavy = heavy_keys(df.where(F.col(key).isNotNull()), [key], heavy_share)
    light = df.join(F.broadcast(heavy), key, "left_anti").join(right, key, how)
    hot = df.join(F.broadcast(heavy.join(right, key, how)), key)
    return light.unionByName(hot.select(*light.columns))
