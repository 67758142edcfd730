"""Repetition inside a document, and how far its text is from its language.

The divergences compare a document's character classes and common words with references made from the
whole corpus. They can't tell how many windows of a text repeat earlier ones, so the share of repeated
windows is counted exactly beside them, in the same pass and behind the same guard of a least length.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .words import code_points, words

WINDOW, LEAST_WINDOWS, SHARE = 5, 20, 0.3
#: Words of a language's reference; (language, word) pairs a task holds before it writes partial counts.
COMMON, HELD = 200, 200_000
#: Languages, those with the most text, whose references are broadcast; those of further ones are joined.
LANGUAGES = 1000
#: Character classes: Latin, Hangul, other letters, digits, marks, white space, punctuation, the rest.
CLASSES = 8


@cache
def _classes() -> np.ndarray:
    def of(c: int) -> int:
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            if c < 0x250:
                return 0
            return 1 if 0x1100 <= c < 0x1200 or 0x3130 <= c < 0x3190 or 0xAC00 <= c < 0xD7B0 else 2
        return {"N": 3, "M": 4, "Z": 5, "P": 6}.get(kind[0], 5 if c in (9, 10, 13) else 7)

    return np.fromiter(map(of, range(0x110000)), np.uint8, 0x110000)


def class_counts(text: str) -> np.ndarray:
    return np.bincount(_classes()[code_points(text)], minlength=CLASSES)


def divergence(p: np.ndarray, q: np.ndarray) -> float | None:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms; None if one is empty."""
    if not p.sum() or not q.sum():
        return None
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


def repeated(found: list[str], window: int = WINDOW) -> tuple[int, int]:
    """Windows of consecutive words, and how many of them equal an earlier one."""
    n = max(0, len(found) - window + 1)
    return n, n - len(set(zip(*(found[i:] for i in range(window))))) if n else 0


def language(col: Column) -> Column:
    """A language tag in small letters; null, blank and undetermined ones are one language of their own."""
    tag = F.lower(F.trim(col))
    return F.when(tag.isNull() | tag.isin("", "und"), F.lit("und")).otherwise(tag)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)
    held = 0

    def out() -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, c in counts.items() for word, n in c.items()]
        return pa.record_batch(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["lang", "word", "n"]
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            counter = counts[lang]
            counter.update(words(text))
            counter.update({f"\0{k}": int(n) for k, n in enumerate(class_counts(text)) if n})
        held = sum(map(len, counts.values()))
        if held >= HELD:
            yield out()
            counts.clear()
    if counts:
        yield out()


def references(docs: DataFrame, *, text: str = "text", lang: str = "lang", common: int = COMMON) -> DataFrame:
    """lang, word, n: of each language, counts of its character classes (words of NUL and a digit), of its
    common most frequent words (ties by the word) and, under an empty word, of all other words.

    All documents are counted; tasks hand on partial counts, of any word at most one row each time.
    """
    counted = cut(
        docs.where(F.col(text).isNotNull())
        .select(language(F.col(lang)).alias("lang"), F.col(text).alias("text"))
        .mapInArrow(_count, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )  # one pass over the texts for all that follows
    is_class = F.col("word").startswith("\0")
    ranked = counted.where(~is_class).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word")))
    # the filter on the rank lets each task keep its first rows only
    top = ranked.where(F.col("rank") <= common).drop("rank")
    sums = counted.where(~is_class).groupBy("lang").agg(F.sum("n").alias("all"))
    rest = top.groupBy("lang").agg(F.sum("n").alias("in_top")).join(sums, "lang").select("lang", F.lit("").alias("word"), (F.col("all") - F.col("in_top")).alias("n"))
    return top.unionByName(rest).unionByName(counted.where(is_class))


#: A language's common words by place, its histogram of them and of all others, and its character classes.
Reference = tuple[dict[str, int], np.ndarray, np.ndarray]


def _reference(counts: dict[str, int]) -> Reference:
    common = sorted(w for w in counts if w and w[0] != "\0")
    return {w: i for i, w in enumerate(common)}, np.array([*(counts[w] for w in common), counts.get("", 0)], float), np.array([counts.get(f"\0{k}", 0) for k in range(CLASSES)], float)


def _distances(text: str, found: list[str], reference: Reference) -> tuple[float | None, float | None]:
    place, common, classes = reference
    own = np.zeros(len(common))
    for word, times in Counter(found).items():
        own[place.get(word, -1)] += times
    return divergence(class_counts(text).astype(float), classes), divergence(own, common)


def _profile(shared, window: int, least: int):
    """shared: the broadcast references by language; without it each row brings the words and counts of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang = {g: _reference(counts) for g, counts in shared.value.items()} if shared is not None else {}
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            brought = zip(batch.column(3), batch.column(4)) if shared is None else repeat((None, None))
            for key, lang, text, (held, counts) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), brought):
                text = text.as_py() or ""
                found = words(text)
                n, again = repeated(found, window)
                if held is not None and held.is_valid and n >= least and lang not in by_lang:
                    by_lang.clear()  # rows of a language lie together
                    by_lang[lang] = _reference(dict(zip(held.as_py(), counts.as_py())))
                apart = _distances(text, found, by_lang[lang]) if n >= least and lang in by_lang else (None, None)
                for column, value in zip(out, (key, n, again, again / n if n else 0.0, *apart)):
                    column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "windows", "repeated", "share", "class_distance", "word_distance"])

    return run


def profiles(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", window: int = WINDOW, least: int = LEAST_WINDOWS, common: int = COMMON, languages: int = LANGUAGES
) -> DataFrame:
    """doc_id, windows, repeated, share, class_distance, word_distance of each document.

    share: windows of consecutive words that equal an earlier one, of all windows. The distances are null
    below least windows, too short a text to judge. Null and empty texts have no window and a share of 0.
    References hold common + 9 counts a language and are broadcast for the languages with the most text;
    documents of any other tag are partitioned by it and meet its reference in a join.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), language(F.col(lang)).alias("lang"), F.col(text).alias("text"))
    by_lang: dict[str, dict[str, int]] = defaultdict(dict)
    counts = cut(references(docs, text=text, lang=lang, common=common))
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    largest = sizes.orderBy(F.desc("all"), "lang").limit(languages).select("lang")
    for row in counts.join(F.broadcast(largest), "lang", "left_semi").collect():
        by_lang[row[0]][row[1]] = row[2]
    shared = docs.sparkSession.sparkContext.broadcast(dict(by_lang))
    kinds = "doc_id long, windows int, repeated int, share double, class_distance double, word_distance double"
    if sizes.count() <= languages:
        return rows.mapInArrow(_profile(shared, window, least), kinds)
    told = F.broadcast(largest)
    main = rows.join(told, "lang", "left_semi").select(*rows.columns).mapInArrow(_profile(shared, window, least), kinds)
    own = counts.groupBy("lang").agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("counts"))
    rest = rows.join(told, "lang", "left_anti").repartition("lang").join(own, "lang", "left").select("doc_id", "lang", "text", "words", "counts").sortWithinPartitions("lang")
    return main.unionByName(rest.mapInArrow(_profile(None, window, least), kinds))
