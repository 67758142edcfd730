"""At-least-once messages: keep one copy of each, moving no payload."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of one bitmap of Spark's bitmap functions, and bytes of bitmaps broadcast at once.
BLOCK = 32768
BROADCAST_BYTES = 32 << 20


def message_key(chunk_id: Column, content_hash: Column) -> Column:
    """16 bytes that two records share exactly if they are copies.

    The part before the first colon must be equal as text, the part after it as a number, the hash
    without regard to case; two null hashes are equal. A tail that is no number counts as text. A null
    chunk_id gives null: such a record is nobody's copy.
    """
    head = F.substring_index(chunk_id, ":", 1)
    tail = F.when(chunk_id.contains(":"), F.regexp_extract(chunk_id, r"(?s)^[^:]*:(.*)$", 1))
    digits = F.regexp_replace(F.regexp_extract(F.trim(tail), r"^\+?([0-9]+)$", 1), r"^0+(?=[0-9])", "")
    seq = F.when(digits != "", digits).otherwise(F.concat(F.lit("="), tail))
    parts = F.to_json(F.struct(head.alias("a"), seq.alias("b"), F.lower(content_hash).alias("c")))
    return F.when(chunk_id.isNotNull(), F.unhex(F.md5(parts.cast("binary"))))


def _placed(df: DataFrame) -> DataFrame:
    return df.withColumns({"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")})


def survivors(spark: SparkSession, path: str, key: Column, order: Column) -> DataFrame:
    """__file, __block, __bits: for each file and block of rows, a bitmap of the rows that stay.

    Only key, order and the place in the file are shuffled, and of each key only the best of a task
    (the minimum is taken before the shuffle), so a key with a third of all rows costs one row a task.
    Ties in order are settled by file and row. A row with a null key stays.
    """
    narrow = _placed(spark.read.parquet(path)).select(key.alias("__key"), F.struct(order.alias("o"), "__file", "__row").alias("__at"))
    best = narrow.where("__key IS NOT NULL").groupBy("__key").agg(F.min("__at").alias("__at")).select("__at")
    own = narrow.where("__key IS NULL").select("__at")
    at = best.unionByName(own).select("__at.__file", F.col("__at.__row").alias("__row"))
    return at.groupBy("__file", F.floor(F.col("__row") / BLOCK).alias("__block")).agg(
        F.expr(f"bitmap_construct_agg(CAST(__row % {BLOCK} AS BIGINT))").alias("__bits")
    )


def _marked(rows: DataFrame, vectors: DataFrame, kept: bool) -> DataFrame:
    """Rows of a placed scan whose bit is set (kept) or is not set; a block without a bitmap has no bit set."""
    octet = f"CAST(conv(hex(substring(__bits, CAST((__row % {BLOCK}) DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    bit = F.coalesce(F.expr(f"shiftright({octet}, CAST(__row % 8 AS INT)) & 1"), F.lit(0))
    joined = rows.withColumn("__block", F.floor(F.col("__row") / BLOCK)).join(F.broadcast(vectors), ["__file", "__block"], "left")
    return joined.where(bit == (1 if kept else 0)).drop("__file", "__block", "__row", "__bits")


def apply_vectors(spark: SparkSession, path: str, vectors: DataFrame, columns: list[str], *, kept: bool = True) -> DataFrame:
    """columns of the rows of path that stay (kept) or that are dropped, read once and never shuffled.

    vectors (from survivors, written already) are broadcast in waves of files: a wave holds at most
    BROADCAST_BYTES of bitmaps, or one file, and scans its own files only.
    """
    sizes = {r[0]: r[1] for r in vectors.groupBy("__file").agg(F.sum(F.length("__bits") + 64)).collect()}  # a row a file
    files = sorted(spark.read.parquet(path).inputFiles())
    waves: list[list[str]] = [[]]
    room = BROADCAST_BYTES
    named = {f: next((k for k in (f, f.replace("file:///", "file:/"), f.replace("file:/", "file:///")) if k in sizes), f) for f in files}
    for f in files:
        need = sizes.get(named[f], 0)
        if waves[-1] and need > room:
            waves.append([])
            room = BROADCAST_BYTES
        waves[-1].append(f)
        room -= need
    parts = []
    for wave in waves:
        if len(waves) == 1:
            rows, own = spark.read.parquet(path), vectors
        else:
            rows, own = spark.read.parquet(*wave), vectors.where(F.col("__file").isin([named[f] for f in wave]))
        parts.append(_marked(_placed(rows).select(*columns, "__file", "__row"), own, kept))
    return reduce(DataFrame.unionByName, parts)
