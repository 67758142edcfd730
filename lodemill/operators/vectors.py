"""An index of vectors: cells around centres, int8 codes in them, exact scores for what they find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import top_per_group
from .retrieval import dense_pairs, question_blocks

#: Vectors from which the centres are made and the probes chosen, whatever the size of the table; rounds of k-means; most cells.
SAMPLE, ROUNDS, MOST_CELLS = 20_000, 12, 4096
#: Of the sample's own nearest ten the share that the probed cells must hold; questions of the sample by which that is measured.
TARGET, ASKED = 0.97, 500
#: Candidates by code for each hit that is asked for.
OVER = 4
ENTRIES = "cell int, id long, scale float, code binary"


def _normal(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _centres(rows: np.ndarray, cells: int) -> np.ndarray:
    """Centres of cells by spherical k-means from a fixed start; an empty cell keeps its centre."""
    centres = rows[np.random.default_rng(7).permutation(len(rows))[:cells]]
    for _ in range(ROUNDS):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        filled = np.bincount(own, minlength=len(centres)) > 0
        centres = np.where(filled[:, None], _normal(sums), centres)
    return centres


def _probes(rows: np.ndarray, centres: np.ndarray) -> int:
    """The least number of cells, nearest first, that hold TARGET of the nearest ten of the sample's questions."""
    asked = rows[:ASKED]
    scores = asked @ rows.T
    near = np.argsort(-scores, axis=1, kind="stable")[:, :10]
    own = (rows @ centres.T).argmax(axis=1)
    places = np.argsort(np.argsort(-(asked @ centres.T), axis=1), axis=1)  # place of each cell for each question
    needed = np.sort(np.take_along_axis(places, own[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))))]) + 1


def _encode(centres: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1)
            cells = (rows @ centres.T).argmax(axis=1).astype(np.int32)
            scale = (np.abs(rows).max(axis=1) / 127).astype(np.float32)
            codes = np.round(rows / np.maximum(scale, 1e-30)[:, None]).astype(np.int8)
            yield pa.record_batch([pa.array(cells), batch.column(0).cast(pa.int64()), pa.array(scale), pa.array([c.tobytes() for c in codes], pa.binary())], ["cell", "id", "scale", "code"])

    return work


def _look(shared, k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, asking = shared.value
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            cells = batch.column(0).to_numpy()
            own, scale = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            codes = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int8).reshape(batch.num_rows, -1) if batch.num_rows else None
            for cell in np.unique(cells):
                here = np.flatnonzero(cells == cell)
                scores = (matrix[asking[cell]] @ codes[here].astype(np.float32).T) * scale[here]
                for q, s in zip(asking[cell], scores):
                    before = best.get(q)
                    s, i = (s, own[here]) if before is None else (np.concatenate([before[0], s]), np.concatenate([before[1], own[here]]))
                    if len(s) > k:
                        top = np.lexsort((i, -s))[:k]
                        s, i = s[top], i[top]
                    best[q] = s, i
        for q, (s, i) in best.items():
            yield pa.record_batch([pa.array(np.full(len(i), ids[q])), pa.array(i), pa.array(s.astype(np.float64))], ["qid", "id", "near"])

    return work


class VectorIndex:
    """Below a folder: entries (every vector's cell and int8 code, sorted by cell) and centres.

    Centres are made, and the number of cells to probe is chosen, from at most SAMPLE vectors; every vector is
    indexed. A cell that holds most vectors is split among files by id. Null vectors are left out.
    """

    def __init__(self, spark: SparkSession, at: str) -> None:
        self.spark, self.at = spark, at
        rows = spark.read.parquet(f"{at}/centres").orderBy("cell").collect()  # at most MOST_CELLS
        self.centres = np.array([r["centre"] for r in rows], np.float64)
        self.probes = rows[0]["probes"] if rows else 0

    @classmethod
    def build(cls, vectors: DataFrame, at: str) -> VectorIndex:
        """Indexes vectors (id, vector) below the folder at, which executors share."""
        spark = vectors.sparkSession
        held = vectors.where("id IS NOT NULL AND vector IS NOT NULL").select(F.col("id").cast("long").alias("id"), "vector")
        count = held.count()
        some = held.where(F.pmod(F.xxhash64("id"), F.lit(max(1, count // SAMPLE))) == 0).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()
        sample = _normal(np.array([r[0] for r in some], np.float64)) if some else np.zeros((0, 1))
        cells = min(MOST_CELLS, max(1, int(len(sample) ** 0.5)), len(sample))
        centres = _centres(sample, cells) if cells else np.zeros((0, 1))
        probes = _probes(sample, centres) if cells else 0
        spark.createDataFrame([(i, c.tolist(), probes) for i, c in enumerate(centres)], "cell int, centre array<double>, probes int").coalesce(1).write.parquet(f"{at}/centres")
        entries = held.mapInArrow(_encode(centres), ENTRIES) if cells else spark.createDataFrame([], ENTRIES)
        entries.repartitionByRange("cell", "id").sortWithinPartitions("cell").write.parquet(f"{at}/entries")
        return cls(spark, at)

    def search(self, questions: DataFrame, vectors: DataFrame, k: int, *, probes: int | None = None) -> DataFrame:
        """qid, id, score, rank: k rows of vectors (id, vector) with great inner products with each question
        (qid, vector), scores exact to six places, ties by the lesser id.

        Only the probed cells' entries are read; OVER times k of them by code meet their vectors.
        """
        found = self.spark.createDataFrame([], "qid long, id long, near double")
        for block in question_blocks(questions.select("qid", "vector")):
            ids, matrix = np.array([r[0] for r in block], np.int64), np.array([r[1] for r in block], np.float32)
            if not len(self.centres):
                continue
            nearest = np.argsort(-(_normal(matrix) @ self.centres.T), axis=1, kind="stable")[:, : probes or self.probes]
            asking: dict[int, np.ndarray] = {int(c): np.flatnonzero((nearest == c).any(axis=1)) for c in np.unique(nearest)}
            entries = self.spark.read.schema(ENTRIES).parquet(f"{self.at}/entries")
            if len(asking) < len(self.centres):
                entries = entries.where(F.col("cell").isin(list(asking)))
            found = found.unionByName(entries.mapInArrow(_look(self.spark.sparkContext.broadcast((ids, matrix, asking)), OVER * k), "qid long, id long, near double"))
        pairs = top_per_group(found, ["qid"], [F.desc("near"), F.col("id")], OVER * k).select("qid", "id")
        return top_per_group(dense_pairs(questions, pairs, vectors), ["qid"], [F.desc("score"), F.col("id")], k)
