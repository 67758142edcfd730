import math
import unicodedata

import numpy as np

from lodemill.llm import repetition
from lodemill.llm.words import words


def test_words():
    texts = ["Ab_c 1½ é", "", None, "가나-다라", "İstanbul", "x́y", "日本 ٣٤", "a​b"]
    for t in texts:
        want, run = [], ""
        for c in (t or "").lower() + " ":
            if unicodedata.category(c)[0] in "LN":
                run += c
            elif run:
                want.append(run)
                run = ""
        assert words(t) == want


def brute(text):
    w = words(text)
    seen, again = set(), 0
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    for x in windows:
        again += x in seen
        seen.add(x)
    return len(windows), again


TEXTS = [None, "", "   ", "one two", "a b c d e " * 10, "a b c d e f g", " ".join(f"w{i}" for i in range(400)), "x " * 24, " ".join(f"w{i % 40}" for i in range(60)), "가 나 다 라 마 바 " * 5]


def test_profiles(spark):
    langs = ["en", "EN", None, "und", "", " en ", "de", "ko", "en", "KO"]
    df = spark.createDataFrame([(i, t, g, 3) for i, (t, g) in enumerate(zip(TEXTS, langs))], "doc_id long, text string, lang string, share int")
    got = {r.doc_id: r for r in repetition.profiles(df).collect()}
    assert sorted(got) == list(range(len(TEXTS)))
    for i, t in enumerate(TEXTS):
        n, again = brute(t)
        assert (got[i].windows, got[i].repeated) == (n, again)
        assert math.isclose(got[i]["share"], again / n if n else 0)
        assert (got[i].class_distance is None) == (n < repetition.LEAST_WINDOWS)
        for d in (got[i].class_distance, got[i].word_distance):
            assert d is None or 0 <= d <= 1
    assert repetition.profiles(df.limit(0)).count() == 0
    few = {r.doc_id: r for r in repetition.profiles(df, languages=1).collect()}  # the others meet their references in a join
    assert few == got and any(r.word_distance is not None for r in got.values())


def test_references(spark):
    df = spark.createDataFrame([("a a b", "en"), ("a c", "EN"), (None, "en"), ("z", None)], "text string, lang string")
    got = {(r.lang, r.word): r.n for r in repetition.references(df, common=2).collect() if not r.word.startswith("\0")}
    assert got == {("en", "a"): 3, ("en", "b"): 1, ("en", ""): 1, ("und", "z"): 1, ("und", ""): 0}


def test_divergence():
    a, b = np.array([1.0, 0, 3]), np.array([2.0, 0, 6])
    assert repetition.divergence(a, b) < 1e-7
    assert repetition.divergence(np.array([1.0, 0]), np.array([0, 5.0])) == 1
    assert repetition.divergence(np.zeros(2), a[:2]) is None
