"""Encoding texts as vectors by a model that each task loads once, in Arrow batches.

A model is made by a function without arguments, which is sent to the tasks: dense ones take a list of texts
and give an array of (texts, dimensions), sparse ones give the logits (texts, tokens, vocabulary) with a mask
(texts, tokens) of the tokens that count. No weights of public models are at hand here; HashedWords stands in
for a dense model, so that everything around one can run.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts a model gets at once, words of a text that it gets at most, and dimensions of the stand-in (fixed values).
BATCH, MOST_WORDS, DIMENSIONS = 16, 512, 1024
_WORD = re.compile(r"\S+")

DenseModel = Callable[[list[str]], np.ndarray]
SparseModel = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def cut_words(text: str, most: int = MOST_WORDS) -> str:
    """The text up to the end of that many words, as models cut their input."""
    for n, word in enumerate(_WORD.finditer(text), 1):
        if n == most:
            return text[: word.end()]
    return text


class HashedWords:
    """Counts of words, each under a place and a sign that its checksum gives, damped by a logarithm."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.dimensions = dimensions

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions))
        for row, text in zip(out, texts):
            for word in _WORD.findall(text.lower()):
                code = zlib.crc32(word.encode("utf-8", "surrogatepass"))
                row[code // 2 % self.dimensions] += 1 if code % 2 else -1
        return np.sign(out) * np.log1p(np.abs(out))


def pooled(logits: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Of each text and vocabulary entry log1p(relu(x)) of the largest logit x of its masked tokens; 0 without any."""
    held = np.where(mask[:, :, None].astype(bool), logits, -np.inf)
    best = held.max(axis=1) if logits.shape[1] else np.full((len(logits), logits.shape[2]), -np.inf)
    return np.log1p(np.maximum(best, 0))


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    for a in range(0, batch.num_rows, BATCH):
        part = batch.slice(a, BATCH)
        yield part.column(0), [cut_words(t) for t in part.column(1).to_pylist()]


def encode_dense(texts: DataFrame, make: Callable[[], DenseModel], *, id: str = "id", text: str = "text") -> DataFrame:
    """id, vector: each text's vector of length 1. Null and blank texts get no row; of a text the first
    MOST_WORDS words are encoded, as by the models this stands for; a vector of zeros stays one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for batch in batches:
            for ids, held in _batches(batch):
                rows = np.asarray(model(held), np.float64)
                rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
                flat = pa.array(rows.astype(np.float32).ravel())
                yield pa.record_batch([ids, pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)), flat)], ["id", "vector"])

    return _rows(texts, id, text).mapInArrow(work, "id long, vector array<float>")


def encode_sparse(texts: DataFrame, make: Callable[[], SparseModel], *, id: str = "id", text: str = "text") -> DataFrame:
    """id, token (place in the vocabulary), weight above 0; see pooled. Null and blank texts get no row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for batch in batches:
            for ids, held in _batches(batch):
                weights = pooled(*model(held))
                row, token = np.nonzero(weights)
                yield pa.record_batch([ids.take(pa.array(row)), pa.array(token.astype(np.int32)), pa.array(weights[row, token])], ["id", "token", "weight"])

    return _rows(texts, id, text).mapInArrow(work, "id long, token int, weight double")


def _rows(texts: DataFrame, id: str, text: str) -> DataFrame:
    return texts.where(F.col(id).isNotNull() & F.col(text).rlike(r"\S")).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
