"""Streams of fetch events and chunk messages into keyed tables.

Every batch is merged under its stream and number, so one that is repeated after a failure changes nothing. The
steps are those of the batch rules; a stream over all events ends in the state that the batch gives.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.keyed import latest
from ..sources.messages import from_messages
from ..sources.versioned import VersionedTable
from .rules import backoff_step

CHUNKS = "chunk_id string, doc_id long, seq int, content_hash string, text string, deleted boolean, offset long"
OUTCOMES = "key long, seq long, verdict string, fail_count int, next_due_at timestamp_ntz, retried boolean"


def _outcomes(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
    fails, last_hash = held.get if held.exists else (0, None)
    state: dict[str, Any] = {"fails": fails, "hash": last_hash, "due": None}
    rows = pd.concat(list(frames)).sort_values(["ts", "seq"])
    out = []
    for row in rows.itertuples(index=False):
        event = {"key": int(row.key), "seq": int(row.seq), "ts": row.ts.to_pydatetime() if not isinstance(row.ts, datetime) else row.ts, "kind": row.kind, "hash": row.hash}
        state, made = backoff_step(state, event)
        out.append(made)
    held.update((int(state["fails"]), state["hash"]))
    yield pd.DataFrame(out, columns=["key", "seq", "verdict", "fail_count", "next_due_at", "retried"])


def outcomes(events: DataFrame) -> DataFrame:
    """The stream of fetch_outcomes; events of a key that come in one batch are put in order, later batches go on."""
    grouped = events.select("key", "seq", "ts", "kind", "hash").groupBy("key")
    return grouped.applyInPandasWithState(_outcomes, OUTCOMES, "fails int, hash string", "append", GroupStateTimeout.NoTimeout)


def _stream_id(checkpoint: str, batch: DataFrame) -> str:
    """The id that Spark gave the stream when its checkpoint was made; a new checkpoint has another."""
    spark = batch.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    lines = spark._jvm.java.util.Scanner(path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path), "UTF-8").useDelimiter("\\A")
    return json.loads(lines.next())["id"]


def into_table(stream: DataFrame, table: VersionedTable, keys: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Merges a stream into a keyed table and ends when all is read: of each key the row last in order, among
    the batch and the table, so an older row that comes late changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        rows = table.read().unionByName(batch.select(*table.read().columns))
        table.replace(latest(rows, keys, F.col(order)), (_stream_id(checkpoint, batch), number))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def chunk_messages(messages: DataFrame, table: VersionedTable, dead: str, checkpoint: str) -> StreamingQuery:
    """Chunk messages (value as JSON) into the table of chunks by chunk_id: the message with the greatest
    offset holds, whatever the order in which batches come; values that are no JSON go to the folder dead.

    A deletion stays in the table as a tombstone, so that an older message that comes later doesn't
    bring the chunk back; living() leaves tombstones out.
    """
    schema = CHUNKS

    def merge(batch: DataFrame, number: int) -> None:
        rows, broken = from_messages(batch.select("value"), schema)
        broken.write.mode("overwrite").json(f"{dead}/batch-{number}")
        last = latest(rows.where("chunk_id IS NOT NULL"), ["chunk_id"], F.col("offset"))
        table.replace(latest(table.read().unionByName(last), ["chunk_id"], F.col("offset")), (_stream_id(checkpoint, batch), number))

    return messages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def living(table: VersionedTable) -> DataFrame:
    """The chunks of such a table that aren't deleted."""
    return table.read().where(~F.coalesce("deleted", F.lit(False))).drop("deleted")


def report(path: str, **values: Any) -> None:
    """A small report of a run as one JSON file."""
    with open(path, "w", encoding="utf-8") as out:
        json.dump(values, out, ensure_ascii=False, default=str)
