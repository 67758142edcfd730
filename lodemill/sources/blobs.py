"""Page sources as gzip files in shards, referred to by blob:// names."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

SCHEME, LEVEL = "blob://", 6


def _place(key: str) -> str:
    full = key.rjust(4, "0")
    return f"{full[:2]}/{full[2:4]}/{full}.gz"


def _put(root: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for batch in batches:
            refs, sizes = [], []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = data or b""
                path = f"{base}/{_place(key)}"
                system.create_dir(path.rpartition("/")[0], recursive=True)
                with system.open_output_stream(path + ".tmp", compression=None) as out:
                    out.write(gzip.compress(data, LEVEL, mtime=0))
                system.move(path + ".tmp", path)  # whole or not at all
                refs.append(SCHEME + key)
                sizes.append(len(data))
            yield pa.record_batch([batch.column(0), pa.array(refs, pa.string()), pa.array(sizes, pa.int64())], ["key", "blob_ref", "byte_size"])

    return work


def put(df: DataFrame, key: str, data: str, root: str) -> DataFrame:
    """Writes each row's bytes and gives key, blob_ref and byte_size; the same bytes always make the same file."""
    return df.select(F.col(key).cast("string"), F.col(data).cast("binary")).mapInArrow(_put(root), "key string, blob_ref string, byte_size long")


@F.arrow_udf(BinaryType())
def unzipped(values: pa.Array) -> pa.Array:
    return pa.array([None if v is None else gzip.decompress(v) for v in values.to_pylist()], pa.binary())


def read(spark: SparkSession, root: str) -> DataFrame:
    """blob_ref and data of every blob below root."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(root)
    return files.select(F.concat(F.lit(SCHEME), F.regexp_extract("path", r"([^/]*)\.gz$", 1)).alias("blob_ref"), unzipped(F.col("content")).alias("data"))


def looks_like_html(data: Column) -> Column:
    """Whether the first 1,024 bytes begin like a page."""
    head = F.lower(F.ltrim(F.decode(F.substring(data, 1, 1024), "ISO-8859-1")))
    return head.startswith("<!doctype html") | head.contains("<html")
