"""Most frequent values by external sort and run-length counting, in bounded memory."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Values that a task holds before it writes a sorted run.
RUN_ROWS = 1 << 18


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of (value, n): of each RUN_ROWS values, every distinct one once."""
    held: list[pa.Array] = []
    rows = 0

    def run() -> pa.RecordBatch:
        counted = pa.chunked_array(held, pa.string()).value_counts()
        values, counts = counted.field(0), counted.field(1)
        order = pc.sort_indices(values)
        return pa.record_batch([values.take(order), counts.take(order).cast(pa.int64())], ["value", "n"])

    for batch in batches:
        held.append(batch.column(0).cast(pa.string()))
        rows += batch.num_rows
        if rows >= RUN_ROWS:
            yield run()
            held, rows = [], 0
    if rows:
        yield run()


def _merge(k: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of one sorted range: its k most frequent values, and a row without value that holds its total."""
        heap: list[tuple[int, str]] = []
        last: str | None = None
        running = total = 0

        def close(value: str, n: int) -> None:
            if len(heap) < k:
                heapq.heappush(heap, (n, value))
            elif (n, value) > heap[0]:
                heapq.heapreplace(heap, (n, value))

        for batch in batches:
            if not batch.num_rows:
                continue
            ends = pc.run_end_encode(batch.column(0))
            values, stops = ends.values, ends.run_ends.to_numpy()
            sums = np.add.reduceat(batch.column(1).to_numpy(), np.concatenate([[0], stops[:-1]]))
            total += int(sums.sum())
            if last is not None and values[0].as_py() == last:
                sums[0] += running
            elif last is not None:
                close(last, running)
            # the last value may go on in the next batch; of the others only those that can enter the heap leave numpy
            inner = sums[:-1]
            least = heap[0][0] if len(heap) == k else 0
            if len(inner) > k:
                least = max(least, int(np.partition(inner, -k)[-k]))
            for i in np.flatnonzero(inner >= least):
                close(values[int(i)].as_py(), int(inner[i]))
            last, running = values[len(values) - 1].as_py(), int(sums[-1])
        if last is not None:
            close(last, running)
        rows = sorted(heap, reverse=True)
        yield pa.record_batch(
            [pa.array([v for _, v in rows] + [None], pa.string()), pa.array([n for n, _ in rows] + [total], pa.int64())], ["value", "n"]
        )

    return merge


def frequent_values(df: DataFrame, column: str, *, share: float, least: int = 1, ranges: int | None = None) -> DataFrame:
    """value, n, total of the values of a string column that make up at least share of its non-null rows.

    Each task sorts what it reads into runs with combined counts; the runs are range-partitioned by
    value and merged; each range keeps a heap of 1/share values. No more than 1/share values can reach
    the share, so the heap loses none and the counts are exact. A value that fills a third of all rows
    costs one row a run. Nulls are not counted; an empty column gives no row; ties need no rule, as
    every value that reaches the share is kept.
    """
    k = int(1 / share) + 1
    runs = df.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").mapInArrow(_runs, "value string, n long")
    parts = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_runs = runs.repartitionByRange(parts, "value").sortWithinPartitions("value")
    tops = cut(sorted_runs.mapInArrow(_merge(k), "value string, n long"))  # at most k + 1 rows a range
    one = F.lit(1).alias("one")
    total = tops.where("value IS NULL").groupBy(one).agg(F.sum("n").alias("total"))
    return (
        tops.where("value IS NOT NULL")
        .withColumn("one", F.lit(1))
        .join(F.broadcast(total), "one")
        .where((F.col("n") >= F.ceil(F.col("total") * F.lit(share) - 1e-6)) & (F.col("n") >= least))
        .select("value", "n", "total")
    )
