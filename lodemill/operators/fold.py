"""State machines over the ordered events of each key, in memory that doesn't grow with a key."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: state, row -> state, output row (None for no output)
Step = Callable[[Any, dict], tuple[Any, tuple | None]]


def _work(key: str, start: Callable[[], Any], step: Step, schema: pa.Schema):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: Any = object()
        state: Any = None
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if row[key] != last:
                    last, state = row[key], start()
                state, made = step(state, row)
                if made is not None:
                    out.append(made)
            columns = list(zip(*out)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return work


def fold(df: DataFrame, key: str, order: list[str], start: Callable[[], Any], step: Step, schema: StructType) -> DataFrame:
    """Runs step over each key's rows in order, with a state that begins anew for each key.

    Rows are partitioned by key and sorted, and go through one by one; only the state of the key at hand
    is held. Order must be total where the outcome hangs on it. A null key is a key of its own.
    """
    rows = df.repartition(key).sortWithinPartitions(key, *order)
    return rows.mapInArrow(_work(key, start, step, to_arrow_schema(schema)), schema)
