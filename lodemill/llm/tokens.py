"""Token ids of a corpus by a public byte-level BPE vocabulary.

Texts are cut into overlapping chunks that are pre-tokenised in parallel; neighbours are stitched where
their pre-token boundaries meet again in the overlap; the pieces between the stitches are encoded and
put together. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: The vocabulary's published pre-token pattern (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a chunk and of its overlap with the next; characters by which the pattern looks ahead.
CHUNK, OVERLAP, AHEAD = 1 << 14, 1 << 10, 3
#: Pre-tokens whose ids are remembered, and the longest such.
KEPT, KEPT_CHARS = 200_000, 48


@cache
def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@cache
def _pattern() -> regex.Pattern:
    return regex.compile(PATTERN)


class Encoder:
    """Ids of texts, as 4-byte little-endian numbers; remembers frequent pre-tokens."""

    def __init__(self, path: str) -> None:
        self._bpe = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=vocabulary(path), special_tokens={})
        self._known: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        got = self._known.get(piece)
        if got is None:
            got = np.asarray(self._bpe.encode_ordinary(piece), "<i4").tobytes()
            if len(piece) <= KEPT_CHARS:
                if len(self._known) >= KEPT:
                    self._known.clear()
                self._known[piece] = got
        return got

    def packed(self, text: str | None) -> bytes:
        return b"".join(map(self._piece, _pattern().findall(text))) if text else b""

    def ids(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), "<i4").tolist()


def decode(ids: list[int], path: str) -> bytes:
    """The bytes that the ids stand for."""
    by_id = _by_id(path)
    return b"".join(by_id[i] for i in ids)


@cache
def _by_id(path: str) -> dict[int, bytes]:
    return {i: b for b, i in vocabulary(path).items()}


def _listed(packed: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))


#: Ids that one output batch holds at most, so that a batch stays small in memory.
BATCH_IDS = 1 << 20


def _encode(path: str, keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            packed: list[bytes] = []
            size = first = 0
            texts = batch.column(keys)

            def out(end: int) -> pa.RecordBatch:
                held = [batch.column(i).slice(first, end - first) for i in range(keys)]
                return pa.record_batch([*held, _listed(packed)], [*batch.schema.names[:keys], "ids"])

            for at in range(batch.num_rows):
                packed.append(encoder.packed(texts[at].as_py()))
                size += len(packed[-1])
                if size >= 4 * BATCH_IDS:
                    yield out(at + 1)
                    packed, size, first = [], 0, at + 1
            if packed:
                yield out(batch.num_rows)

    return run


def _bounds(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Boundaries in a chunk's first characters, and those beyond its end that its cut-off text can't change."""
        for batch in batches:
            heads, tails = [], []
            for text in batch.column(2).to_pylist():
                ends = [m.end() for m in _pattern().finditer(text)]
                heads.append([0, *(e for e in ends if e < overlap)])
                tails.append([e - chunk for e in ends if chunk <= e <= len(text) - AHEAD])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], ["key", "c", "head", "tail"]
            )

    return run


def encode(df: DataFrame, key: str, text: str, path: str, *, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key and ids, one row for each row of df; a null and an empty text give an empty list.

    key must be a BIGINT without repeats. Special tokens are never made: their strings are ordinary
    text. A text of up to chunk characters is encoded by the task that reads it. Chunks of longer ones
    are spread over all tasks; where two neighbours share no boundary in the overlap, that text's rest
    goes on in one piece, so the ids are always those of the whole text.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    long = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = rows.where(~long).mapInArrow(_encode(path, 1), "key long, ids array<int>")
    chunks = rows.where(long).select(
        "key", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chunk).cast("int"))).alias("c"), "text"
    ).select("key", "c", F.substring("text", F.col("c") * chunk + 1, F.lit(chunk + overlap)).alias("text"))
    chunks = cut(chunks.repartition("key", "c"))  # read for their boundaries and for their pieces
    bounds = chunks.mapInArrow(_bounds(chunk, overlap), "key long, c int, head array<int>, tail array<int>")
    after = bounds.select("key", (F.col("c") - 1).alias("c"), F.col("head").alias("next"))
    in_order = Window.partitionBy("key").orderBy("c")
    met = bounds.join(after, ["key", "c"], "left").select("key", "c", F.array_min(F.array_intersect("tail", "next")).alias("cut"))
    # a cut holds only if all cuts before it do
    held = F.max(F.col("cut").isNull().cast("int")).over(in_order) == 0
    met = met.withColumn("cut", F.when(held, F.col("cut")))
    cuts = met.select(
        "key", "c", "cut", F.lag("cut").over(in_order).alias("begin"), F.count("cut").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("part")
    )
    begin = F.coalesce(F.col("begin"), F.lit(0))
    piece = F.substring("text", begin + 1, F.lit(chunk) + F.coalesce(F.col("cut"), F.lit(0)) - begin)
    pieces = chunks.join(cuts, ["key", "c"]).groupBy("key", "part").agg(F.array_sort(F.collect_list(F.struct("c", piece.alias("t")))).alias("ts"))
    encoded = pieces.select("key", F.col("part").cast("long"), F.array_join(F.transform("ts", lambda x: x.t), "").alias("text")).mapInArrow(
        _encode(path, 2), "key long, part long, ids array<int>"
    )
    whole = encoded.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("all"))
    joined = whole.select("key", F.flatten(F.transform("all", lambda x: x.ids)).alias("ids"))
    return short.unionByName(joined).select(F.col("key").alias(key), "ids")
