import random
import tracemalloc
import unicodedata

import numpy as np
import pytest

from lodemill.llm import leaks as leaks_module
from lodemill.llm.leaks import folded, leaks, spans


def flat(text):
    kept = unicodedata.normalize("NFC", text or "").lower()
    return "".join(c for c in kept if unicodedata.category(c)[0] in "LN")


def longest_common(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else 0)
        best, row = max(best, max(new)), new
    return best


def edit_run(text, item, edits):
    """Longest run of item characters within edits edits of some part of the text."""
    best = 0
    for i in range(len(item)):
        row = [0] * (len(text) + 1)
        for j in range(i, len(item)):
            new = [row[0] + 1]
            for k, c in enumerate(text):
                new.append(min(row[k] + (c != item[j]), row[k + 1] + 1, new[k] + 1))
            row = new
            if min(row) <= edits:
                best = max(best, j - i + 1)
    return best


def corpus():
    chooser = random.Random(4)
    word = lambda: "".join(chooser.choice("abcdef가나다라") for _ in range(chooser.randint(2, 6)))
    items = [" ".join(word() for _ in range(30)) for _ in range(12)]
    docs = []
    for k in range(60):
        base = [" ".join(word() for _ in range(chooser.randint(0, 40))) for _ in range(2)]
        item = chooser.choice(items)
        size = chooser.choice([30, 49, 50, 60, 90, len(item)])
        start = chooser.randint(0, max(0, len(item) - size))
        piece = list(item[start : start + size])
        for _ in range(chooser.choice([0, 0, 1, 2, 4])):
            piece.insert(chooser.randrange(len(piece)), chooser.choice("xyz!,"))
        docs.append(base[0] + "! " + "".join(piece).upper() + " - " + base[1])
    return docs, items


@pytest.mark.parametrize("at_once", [1 << 20, 64])
def test_against_brute_force(spark, monkeypatch, at_once):
    docs, items = corpus()
    docs += [None, "", "short", items[0], items[0] + items[0], unicodedata.normalize("NFD", items[1])]
    items += [None, "", "short", items[0]]
    monkeypatch.setattr(leaks_module, "AT_ONCE", at_once)
    d = spark.createDataFrame([(i, t, 1) for i, t in enumerate(docs)], "doc_id long, text string, item_id int")
    e = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched for r in leaks(d, e).collect() if r.exact == r.matched}
    edited = {(r.doc_id, r.item_id): r.exact for r in leaks(d, e, edits=2).collect() if r.exact >= 50}
    want = {(i, j): n for i, t in enumerate(docs) for j, u in enumerate(items) if (n := longest_common(flat(t), flat(u))) >= 50}
    assert got == want and want and edited == want


def test_edits(spark):
    docs, items = corpus()
    docs, items = docs[:16], items[:8]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    e = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(d, e, edits=2).collect()}
    want = {(i, j) for i, t in enumerate(docs) for j, u in enumerate(items) if longest_common(flat(t), flat(u)) >= 12 and edit_run(flat(t), flat(u), 2) >= 50}
    assert got == want and want > {(i, j) for i, t in enumerate(docs) for j, u in enumerate(items) if longest_common(flat(t), flat(u)) >= 50} - {None}


def test_blocks_of_items(spark, monkeypatch):
    docs, items = corpus()
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    e = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    one = {tuple(r) for r in leaks(d, e).collect()}
    monkeypatch.setattr(leaks_module, "ITEM_GRAMS", 200)
    assert {tuple(r) for r in leaks(d, e).collect()} == one
    assert leaks(d.limit(0), e).count() == 0 and leaks(d, e.limit(0)).count() == 0
    with pytest.raises(ValueError):
        leaks(d, e, edits=5)


def test_spans():
    text, item = folded("xxabcdefghij"), folded("abcdXfghij")
    at = lambda w, k, e: int(spans(text, np.array([0]), np.array([len(text)]), [item], np.array([w]), k, e)[0][0])
    assert (at(2, 1, 0), at(2, 1, 1), at(3, 1, 0)) == (5, 10, 0)


@pytest.mark.parametrize("dense_least, piece", [(0, 1 << 21), (1 << 16, 50), (1 << 16, 1 << 21)])
def test_repeated_grams(monkeypatch, dense_least, piece):
    """Items of a few letters in turn share q-grams at very many places with texts like them."""
    monkeypatch.setattr(leaks_module, "DENSE_LEAST", dense_least)
    monkeypatch.setattr(leaks_module, "PIECE", piece)
    monkeypatch.setattr(leaks_module, "DENSE_SHARE", 1 << 30 if not dense_least else 40)
    monkeypatch.setattr(leaks_module, "ACROSS", 16)
    items = ["ab" * 40, "ab" * 20 + "x" + "ab" * 20, "abc" * 20 + "de" * 15, "ab" * 30 + "qrstuvwxyz" * 2, "nothing in common with the others at all, nothing in common"]
    texts = ["ab" * 90, "zz" + "ab" * 27 + "y" + "ab" * 27, "abc" * 18 + "xx" + "de" * 20, "q" * 60, "ab" * 26 + "qrstuvwxyz", "abc" * 17, ""]
    flat_items, flat_texts = [flat(i) for i in items], [flat(t) for t in texts]
    index = leaks_module.Index.of(list(range(len(items))), items, 10)
    got: dict = {}
    for n, i, z, e in leaks_module._scan(index, [folded(t) for t in texts], 50, 10, 2):
        before = got.get((n, i), (0, 0))
        got[n, i] = max(before[0], z), max(before[1], e)
    want = {(n, i): z for n, t in enumerate(flat_texts) for i, u in enumerate(flat_items) if (z := edit_run(t, u, 2)) >= 50 and longest_common(t, u) >= 12}
    assert {k: z for k, (z, _) in got.items()} == want
    assert all(e == longest_common(flat_texts[n], flat_items[i]) for (n, i), (_, e) in got.items() if e >= 50)
    assert {k for k, (_, e) in got.items() if e >= 50} == {(n, i) for n, t in enumerate(flat_texts) for i, u in enumerate(flat_items) if longest_common(t, u) >= 50}


def test_a_long_text_of_one_repeated_gram():
    """A million characters against an item with the same q-grams throughout: bounded memory, no listing of all places."""
    text = folded("ab" * (1 << 19))
    for item, want in (("ab" * 500, (1000, 1000)), ("ab" * 250 + "x" + "ab" * 249 + "y", (1000, 500))):
        index = leaks_module.Index.of([0], [item], 10)
        tracemalloc.start()
        got = list(leaks_module._scan(index, [text], 50, 10, 2))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert [g[2:] for g in got] == [want] and peak < 1 << 29
