"""Messages as JSON: writing, tolerant reading, dead letters, replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_messages(df: DataFrame, key: str, topic: str) -> DataFrame:
    """topic, key, value: each row as a JSON value under its key."""
    return df.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def from_messages(messages: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """The rows of JSON values, and the messages whose value is none: (rows, dead letters).

    A value must be an object; fields that schema doesn't name are dropped, missing ones are null.
    """
    parsed = messages.withColumn("__row", F.from_json("value", f"{schema}, __bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}))
    broken = F.col("__row").isNull() | F.col("__row.__bad").isNotNull() | F.col("value").isNull()
    rows = parsed.where(~broken).select(*[c for c in messages.columns if c != "value"], "__row.*").drop("__bad")
    return rows, parsed.where(broken).drop("__row").withColumn("error", F.lit("not a JSON object"))


def stream(spark: SparkSession, path: str, schema: str, *, files_per_trigger: int = 16, replay: bool = False) -> DataFrame:
    """A stream of message files; replay reads them from the first in a batch."""
    if replay:
        return spark.read.schema(schema).json(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)
