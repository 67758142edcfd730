"""Dense, sparse and fused retrieval, reranking, expansion and its measures.

Questions are a small table beside the corpus. They are searched in all rows in blocks: each task
multiplies its own rows with all questions and hands on its own first k, so no product is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import top_per_group

#: Bytes of question vectors that a task holds at once, and places of the scores that count.
BLOCK_BYTES, PLACES = 16 << 20, 6
RRF_K = 60


def _block(shared, k: int, per_group: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, allowed = shared.value
        best_scores: np.ndarray | None = None
        best_ids: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.asarray(batch.column(0).to_pylist(), np.int64)
            rows = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1)
            scores = np.round(matrix @ rows.T, PLACES) + 0.0
            if per_group:
                groups = np.asarray(batch.column(2).to_pylist(), object)
                scores = np.where(allowed[:, None] == groups[None, :], scores, -np.inf)
            keys = np.broadcast_to(own, scores.shape)
            if best_scores is not None:
                scores, keys = np.hstack([best_scores, scores]), np.hstack([best_ids, keys])
            order = np.lexsort((keys, -scores), axis=1)[:, :k]
            best_scores, best_ids = np.take_along_axis(scores, order, 1), np.take_along_axis(keys, order, 1)
        if best_scores is not None:
            keep = np.isfinite(best_scores)
            qids = np.broadcast_to(ids[:, None], best_ids.shape)
            yield pa.record_batch([pa.array(qids[keep]), pa.array(best_ids[keep]), pa.array(best_scores[keep])], ["qid", "id", "score"])

    return work


def question_blocks(questions: DataFrame) -> Iterator[list]:
    """Rows of questions (qid, vector, ...) with a vector, in lists of at most BLOCK_BYTES of vectors."""
    block: list = []
    room = BLOCK_BYTES
    for row in questions.where("vector IS NOT NULL").toLocalIterator():
        if block and room < 8 * len(row[1]):
            yield block
            block, room = [], BLOCK_BYTES
        block.append(row)
        room -= 8 * len(row[1])
    if block:
        yield block


def dense_topk(questions: DataFrame, corpus: DataFrame, k: int, *, group: str | None = None) -> DataFrame:
    """qid, id, score, rank: the k rows of corpus (id, vector) with the greatest inner product of each
    question (qid, vector), scores to six places, ties by the lesser id.

    Vectors have one length and no nulls; rows with a null vector are left out. group: a column of both
    tables; a question then meets its own group's rows only, before the k are taken.
    """
    columns = ["qid", "vector", *([group] if group else [])]
    rows = corpus.where("vector IS NOT NULL").select("id", "vector", *([group] if group else []))
    found = None
    for block in question_blocks(questions.select(*columns)):
        held = (np.array([r[0] for r in block], np.int64), np.array([r[1] for r in block], np.float64), np.array([r[2] for r in block], object) if group else None)
        part = rows.mapInArrow(_block(corpus.sparkSession.sparkContext.broadcast(held), k, group is not None), "qid long, id long, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = corpus.sparkSession.createDataFrame([], "qid long, id long, score double")
    return top_per_group(found, ["qid"], [F.desc("score"), F.col("id")], k)


def tokens(texts: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """id, token, tf: letters' runs of the text in small letters, with how often they occur."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda x: x != "")
    return texts.where(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.explode(words).alias("token")).groupBy("id", "token").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy("token").agg(F.count(F.lit(1)).alias("df"))


def idf(count: Column, df: Column) -> Column:
    return F.log(1 + (count - df + 0.5) / (df + 0.5))


def sparse_topk(terms: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """qid, id, score, rank: the k ids with the greatest sum of weight * weight over the tokens they share
    with a question. terms: qid, token, weight; postings: id, token, weight. A frequent token's postings
    are split by the hash of their id before they meet the questions, so it doesn't fill one task."""
    salts = 8
    spread = terms.withColumn("salt", F.explode(F.array(*map(F.lit, range(salts)))))
    held = postings.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    hits = held.join(spread.withColumnRenamed("weight", "qw"), ["token", "salt"])
    scores = hits.groupBy("qid", "id").agg(F.round(F.sum(F.col("qw") * F.col("weight")), PLACES).alias("score"))
    return top_per_group(scores, ["qid"], [F.desc("score"), F.col("id")], k)


def _scan(shared, k: int | None):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, starts, places, weights, ids, gold = shared.value
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))  # question's place, id, score
        least, above = np.full(len(ids), -np.inf), np.zeros(len(ids), np.int64)
        for batch in batches:
            own = np.asarray(batch.column(0).to_pylist(), np.int64)
            held = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(held), 0).to_numpy(zero_copy_only=False)
            codes = pc.fill_null(pc.index_in(held.flatten(), value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(len(own)), sizes)
            cells, times = np.unique((rows * len(words) + codes)[codes >= 0], return_counts=True)
            rows, codes = np.divmod(cells, len(words))
            ends = np.searchsorted(rows, np.arange(len(own) + 1))
            per = max(1, (BLOCK_BYTES // 8) // max(1, len(ids)))
            for first in range(0, len(own), per):
                some = slice(ends[first], ends[min(first + per, len(own))])
                count = min(per, len(own) - first)
                n = starts[codes[some] + 1] - starts[codes[some]]
                scores = np.zeros(count * len(ids))
                # in pieces, since a frequent token stands in most questions
                for piece in np.split(np.arange(len(n)), np.searchsorted(np.cumsum(n), np.arange(BLOCK_BYTES // 8, n.sum(), BLOCK_BYTES // 8))):
                    m = n[piece]
                    at = np.repeat(starts[codes[some][piece]] - np.cumsum(m) + m, m) + np.arange(m.sum())
                    cell = np.repeat(rows[some][piece] - first, m) * len(ids) + places[at]
                    scores += np.bincount(cell, weights[at] * np.repeat(times[some][piece], m), len(scores))
                met = scores > 0
                scores = np.round(scores, PLACES).reshape(count, len(ids))
                if k is None:
                    mine = own[first : first + count, None]
                    above += (met.reshape(scores.shape) & (mine != ids) & ((scores > gold) | (scores == gold) & (mine < ids))).sum(0)
                    continue
                row, place = np.nonzero(met.reshape(scores.shape) & (scores >= least))
                place, keys, score = (np.concatenate(x) for x in zip(best, (place, own[first + row], scores[row, place])))
                order = np.lexsort((keys, -score, place))
                place, keys, score = place[order], keys[order], score[order]
                rank = np.arange(len(place)) - np.searchsorted(place, place)
                best = tuple(x[rank < k] for x in (place, keys, score))
                least[place[rank == k - 1]] = score[rank == k - 1]
        if k is None:
            yield pa.record_batch([pa.array(ids), pa.array(above)], ["qid", "above"])
        else:
            yield pa.record_batch([pa.array(ids[best[0]]), pa.array(best[1]), pa.array(best[2])], ["qid", "id", "score"])

    return work


def _scanned(terms: DataFrame, texts: DataFrame, k: int | None, gold: DataFrame | None = None) -> DataFrame | None:
    """What _scan gives of the texts (id, words) for blocks of questions."""
    golds = terms.select("qid").distinct().join(gold.select("qid", "score"), "qid", "left") if gold is not None else terms.select("qid").distinct().withColumn("score", F.lit(None).cast("double"))
    asked = terms.groupBy("qid").agg(F.collect_list(F.struct("token", "weight")).alias("terms")).join(golds, "qid")
    found, block, room = None, [], BLOCK_BYTES
    sent = asked.sparkSession.sparkContext.broadcast
    kind = "qid long, above long" if k is None else "qid long, id long, score double"

    def search() -> DataFrame:
        words: dict[str, int] = {}
        flat = sorted((words.setdefault(token, len(words)), place, weight) for place, row in enumerate(block) for token, weight in row[1])
        codes, places, weights = (np.array(x) for x in zip(*flat))
        starts = np.searchsorted(codes, np.arange(len(words) + 1))
        ids = np.array([row[0] for row in block], np.int64)
        golds = np.array([np.inf if row[2] is None else row[2] for row in block])
        part = texts.select("id", "words").mapInArrow(_scan(sent((pa.array(words, pa.string()), starts, places, weights, ids, golds)), k), kind)
        return part if found is None else found.unionByName(part)

    for row in asked.toLocalIterator():
        if block and room < 64 * len(row[1]):
            found, block, room = search(), [], BLOCK_BYTES
        block.append(row)
        room -= 64 * len(row[1])
    return search() if block else found


def word_lists(texts: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """id, words: letters' runs of each text in small letters, as tokens() counts them."""
    return texts.where(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda x: x != "").alias("words"))


def sparse_scan(terms: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """As sparse_topk, for texts (id, words) whose weights are their tokens' counts. Each task scores its own
    texts against blocks of questions and hands on its first k, so that a question's frequent tokens, which
    meet most texts, take no shuffle."""
    found = _scanned(terms, texts, k)
    if found is None:
        found = texts.sparkSession.createDataFrame([], "qid long, id long, score double")
    return top_per_group(found, ["qid"], [F.desc("score"), F.col("id")], k)


def sparse_gold_ranks(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """qid, rank: the place of the text whose id is the question's among all texts that share a token with it."""
    scores = sparse_pairs(terms, terms.select("qid", F.col("qid").alias("id")).distinct(), texts)
    found = _scanned(terms, texts, None, scores)
    if found is None:
        found = texts.sparkSession.createDataFrame([], "qid long, above long")
    return found.groupBy("qid").agg((F.sum("above") + 1).alias("rank")).join(scores.select("qid"), "qid", "left_semi")


def sparse_pairs(terms: DataFrame, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """qid, id, score of those of the pairs (qid, id) that share a token."""
    held = pairs.join(texts, "id").select("qid", "id", F.explode("words").alias("token")).groupBy("qid", "id", "token").agg(F.count(F.lit(1)).alias("tf"))
    return held.join(terms, ["qid", "token"]).groupBy("qid", "id").agg(F.round(F.sum(F.col("weight") * F.col("tf")), PLACES).alias("score"))


def dense_pairs(questions: DataFrame, pairs: DataFrame, corpus: DataFrame) -> DataFrame:
    """qid, id, score of the pairs (qid, id) whose question and row both have a vector."""
    held = pairs.join(corpus.select("id", "vector"), "id").join(questions.select("qid", F.col("vector").alias("asked")), "qid").where("vector IS NOT NULL AND asked IS NOT NULL")
    each = F.zip_with("asked", "vector", lambda a, b: a.cast("double") * b.cast("double"))
    return held.select("qid", "id", F.round(F.aggregate(each, F.lit(0.0), lambda x, y: x + y), PLACES).alias("score"))


def fuse(*legs: DataFrame, k: int, constant: int = RRF_K) -> DataFrame:
    """qid, id, score, rank: reciprocal-rank fusion; each leg's rank, from 1, gives 1 / (constant + rank)."""
    whole = legs[0].select("qid", "id", "rank")
    for leg in legs[1:]:
        whole = whole.unionByName(leg.select("qid", "id", "rank"))
    # a term a leg at most, added in the order of size, so that the sum doesn't hang on the tasks' order
    terms = whole.groupBy("qid", "id").agg(F.sort_array(F.collect_list(1.0 / (constant + F.col("rank")))).alias("terms"))
    scores = terms.select("qid", "id", F.round(F.aggregate("terms", F.lit(0.0), lambda x, y: x + y), PLACES).alias("score"))
    return top_per_group(scores, ["qid"], [F.desc("score"), F.col("id")], k)


def append_unseen(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Rows of base, then those of extra that base doesn't have for that question; ranks go on."""
    first = base.select("qid", "id", "rank").withColumn("leg", F.lit(0))
    more = extra.join(base.select("qid", "id"), ["qid", "id"], "left_anti").select("qid", "id", "rank").withColumn("leg", F.lit(1))
    return top_per_group(first.unionByName(more), ["qid"], [F.col("leg"), F.col("rank"), F.col("id")], 1 << 30, "place")


def overlap_score(a: Column, b: Column) -> Column:
    """A stand-in for a model that scores a question and a text: shared tokens of all the question's."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda x: x != ""))
    wanted = words(a)
    return F.when(F.size(wanted) > 0, F.size(F.array_intersect(wanted, words(b))) / F.size(wanted)).otherwise(F.lit(0.0))


def rerank(hits: DataFrame, score: Column | Callable[[DataFrame], DataFrame], k: int) -> DataFrame:
    """The k hits of each question with the best score; score is an expression over the hits, an Arrow UDF too."""
    return top_per_group(hits.drop("rank").withColumn("score", F.round(score, PLACES)), ["qid"], [F.desc("score"), F.col("id")], k)


def break_ties(hits: DataFrame, k: int) -> DataFrame:
    """Hits ordered by the score to two places, then by pagerank (none is 0), then as they were; first k."""
    order = [F.desc(F.bround("score", 2)), F.desc(F.coalesce("pagerank", F.lit(0.0))), F.col("rank")]
    return top_per_group(hits.withColumnRenamed("rank", "was").withColumn("rank", F.col("was")).drop("was"), ["qid"], order, k, "place")


def measures(ranks: DataFrame, cuts: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """Recall at each cut, mean reciprocal rank and median rank of one row a question with its gold's rank."""
    return ranks.agg(
        *[F.round(F.avg((F.col("rank") <= c).cast("double")), 6).alias(f"recall_{c}") for c in cuts],
        F.round(F.avg(1.0 / F.col("rank")), 6).alias("mrr"), F.percentile("rank", 0.5).alias("median_rank"), F.count(F.lit(1)).alias("questions"),
    )
