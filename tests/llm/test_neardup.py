import random
from itertools import combinations

import numpy as np
import pytest

from lodemill.llm import neardup
from lodemill.llm.neardup import bands, NearDuplicates, folded, tokens


def grams(text):
    flat = folded(text)
    return {flat[i : i + 5] for i in range(len(flat) - 4)}


def similarity(a, b):
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x and y else 0


def corpus():
    chooser = random.Random(11)
    sentence = lambda: " ".join("".join(chooser.choice("abcdefghijkl가나다라마") for _ in range(chooser.randint(3, 7))) for _ in range(8)) + ". "
    texts = []
    for _ in range(40):
        base = [sentence() for _ in range(chooser.randint(2, 9))]
        for _ in range(chooser.randint(1, 5)):
            copy = list(base)
            for _ in range(chooser.randint(0, 3)):
                copy[chooser.randrange(len(copy))] = sentence()
            if chooser.random() < 0.2:
                chooser.shuffle(copy)
            texts.append("".join(copy))
    return texts


def test_pairs_and_classes(spark):
    texts = corpus()
    texts += [texts[0]] * 4 + [texts[0].upper().replace(" ", "\t"), None, "", "abcd", "ab cd", "a​bcde", "ABCDE"]
    rows = [(f"c{i}", t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "chunk_id string, text string, digest string").repartition(6)
    near = NearDuplicates(df, "chunk_id", "text")
    got = {(r.a, r.b) for r in near.pairs().collect()}
    want = {tuple(sorted((f"c{i}", f"c{j}"))) for i, j in combinations(range(len(texts)), 2) if similarity(texts[i], texts[j]) >= 0.6}
    edge = {p for p in want if similarity(texts[int(p[0][1:])], texts[int(p[1][1:])]) < 0.62}
    assert got <= want
    assert want - got <= edge and len(want - got) <= 0.02 * len(want)
    classes = {r.id: r for r in near.classes().collect()}
    assert set(classes) == {f"c{i}" for i, t in enumerate(texts) if grams(t)}
    root = {c: c for c in classes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in got:
        root[find(a)] = find(b)
    for a, b in combinations(classes, 2):
        assert (classes[a].class_id == classes[b].class_id) == (find(a) == find(b))
    for c in classes:
        assert classes[c].links == sum(c in p for p in got)


@pytest.mark.parametrize("hot, one_in", [(neardup.HOT, neardup.ONE_IN), (2, 1), (2, 3)])
def test_hot_group_of_edited_copies(spark, monkeypatch, hot, one_in):
    """A third of all rows in one group, edited and not, its parts split among tasks or not."""
    monkeypatch.setattr(neardup, "HOT", hot)
    monkeypatch.setattr(neardup, "ONE_IN", one_in)
    chooser = random.Random(3)
    base = [f"sentence number {i} of the base text with words {chooser.random()}. " for i in range(12)]
    many = ["".join(base[:k] + [f"edit {i}. "] + base[k:]) for i, k in enumerate([3, 5, 5, 9, 0])] + ["".join(base)] * 15
    cold = [" ".join(f"{chooser.random()}" for _ in range(20)) for _ in range(40)]
    df = spark.createDataFrame([(f"{i:03}", t) for i, t in enumerate(many + cold)], "chunk_id string, text string")
    assert NearDuplicates(df, "chunk_id", "text").pairs().count() == 20 * 19 // 2


def test_empty(spark):
    df = spark.createDataFrame([], "chunk_id string, text string")
    near = NearDuplicates(df, "chunk_id", "text")
    assert near.pairs().count() == 0 and near.classes().count() == 0


def test_bound_and_size():
    a, b = tokens(folded("the quick brown fox jumps over the dog " * 3), 5), tokens(folded("the quick brown cat jumps over the dog, " * 3), 5)
    fa, fb = neardup.sketch(a)[0], neardup.sketch(b)[0]
    apart = sum(int(x).bit_count() for x in (fa ^ fb).view(np.uint64))
    assert apart <= len(np.setxor1d(a, b))
    assert len(a) == len(grams("the quick brown fox jumps over the dog " * 3))


def test_bands_of_sizes_meet():
    for similarity in (0.6, 0.8):
        for n in [*range(1, 300), 1023, 1024, 1025, 1700, 1706, 1707, 1708, 32768, 50000, 54613, 54614]:
            for m in {n, n + 1, int(n / similarity), int(n / similarity) - 1}:
                if m >= n >= similarity * m:
                    assert bands(n, similarity)[0] in bands(m, similarity)
