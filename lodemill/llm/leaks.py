"""Held-out items inside corpus texts, by q-gram counting in diagonal bands and banded alignment.

An item window of w characters that a text holds with at most e edits shares at least w - q + 1 - q * e
q-grams with it, on diagonals (place in the text less place in the item) at most e apart. Bands of
2 * (e + 1) diagonals overlap by half, so all these q-grams fall into one band.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import code_points, letters_and_digits

#: Characters of a window, of a q-gram; code points handled at once; q-grams of items a task holds at once.
WINDOW, Q, AT_ONCE, ITEM_GRAMS = 50, 10, 1 << 20, 1 << 22
#: Places of one q-gram in one item above which its hits are not listed place by place before they are weighed;
#: hits listed at once; a pair's listed hits, and its share of all cells, above which its diagonals are counted whole.
REPEATS, PIECE, DENSE_LEAST, DENSE_SHARE = 8, 1 << 21, 1 << 16, 40
#: Diagonals aligned at once where neighbouring bands of one pair are retained.
ACROSS = 1 << 15
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20


def folded(text: str | None) -> np.ndarray:
    """Code points after NFC and lower-casing, letters and digits only."""
    if not text:
        return np.zeros(0, np.uint32)
    points = code_points(unicodedata.normalize("NFC", text).lower())
    return points[letters_and_digits()[points]]


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    wide = points.astype(np.uint64)
    for j in range(q):
        h *= _BASE
        h += wide[j : j + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


@dataclass
class Index:
    """Items as code points, and where each of their q-grams stands.

    grams are sorted; gram u stands at the places first[u]:first[u + 1] of item and at. Where one stands more
    than REPEATS times in one item, these places are a group instead: groups group_first[u]:group_first[u + 1]
    have their item, and group_at[group_start[g]:group_start[g + 1]] as places.
    """

    ids: list[int]
    points: list[np.ndarray]
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray
    group_first: np.ndarray
    group_item: np.ndarray
    group_start: np.ndarray
    group_at: np.ndarray
    seen: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str | None], q: int) -> Index:
        points = [folded(t) for t in texts]
        grams = [_grams(p, q) for p in points]
        item = np.repeat(np.arange(len(points)), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, int)])
        every = np.concatenate(grams or [np.zeros(0, np.uint64)])
        order = np.argsort(every, kind="stable")
        every, item, at = every[order], item[order], at[order]
        unique = np.unique(every)
        fresh = np.flatnonzero(np.concatenate([[True], (every[1:] != every[:-1]) | (item[1:] != item[:-1])])) if len(every) else np.zeros(0, int)
        sizes = np.diff(np.append(fresh, len(every)))
        often = np.repeat(sizes > REPEATS, sizes)
        heads = fresh[sizes > REPEATS]
        bounds = lambda held: np.append(np.searchsorted(held, unique), len(held))
        seen = np.zeros(1 << _BITS, bool)
        seen[unique >> np.uint64(64 - _BITS)] = True
        return cls(
            ids, points, unique, bounds(every[~often]), item[~often], at[~often],
            bounds(every[heads]), item[heads], np.concatenate([[0], np.cumsum(sizes[sizes > REPEATS])]).astype(int), at[often], seen,
        )


def spans(text: np.ndarray, starts: np.ndarray, stops: np.ndarray, items: list[np.ndarray], diagonals: np.ndarray, width: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Banded alignment of many (text, item) pairs at once: the longest runs of item characters aligned
    with at most that many edits and with none, on the width diagonals from diagonals on."""
    count, longest = len(items), max((len(i) for i in items), default=0)
    sheet = np.zeros((count, longest), np.uint32)
    for r, i in enumerate(items):
        sheet[r, : len(i)] = i
    sizes = np.array([len(i) for i in items])
    band = diagonals[:, None] + np.arange(width)[None, :]
    best, exact = np.zeros(count, np.int64), np.zeros(count, np.int64)
    # run[k]: item characters aligned up to here with k edits or fewer
    run = [np.zeros((count, width), np.int16 if longest < 1 << 14 else np.int32) for _ in range(edits + 1)]
    for i in range(longest):
        place = starts[:, None] + band + i
        there = (band + i >= 0) & (place < stops[:, None])
        equal = there & (text[np.clip(place, 0, max(len(text) - 1, 0))] == sheet[:, i : i + 1])
        now = []
        for k in range(edits + 1):
            new = np.where(equal, run[k] + 1, 0)
            if k:
                new = np.maximum(new, np.where(there, run[k - 1] + 1, 0))  # substituted
                new[:, :-1] = np.maximum(new[:, :-1], run[k - 1][:, 1:] + 1)  # item character missing in the text
                new[:, 1:] = np.maximum(new[:, 1:], now[k - 1][:, :-1])  # text character missing in the item
            new[i >= sizes] = 0
            now.append(new)
        run = now
        best = np.maximum(best, run[edits].max(axis=1, initial=0))
        exact = np.maximum(exact, run[0].max(axis=1, initial=0))
    return best, exact


def _spread(begin: np.ndarray, times: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... (times[i] of them) for each i, one after the other."""
    return np.repeat(begin - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(int(times.sum()))


def _pieces(times: np.ndarray) -> Iterator[slice]:
    """Slices that hold about PIECE of the times each."""
    total = np.cumsum(times)
    a = 0
    while a < len(times):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + PIECE)))
        yield slice(a, b)
        a = b


class _Counts:
    """Sums by key, merged whenever many keys are held."""

    def __init__(self) -> None:
        self._keys: list[np.ndarray] = []
        self._sums: list[np.ndarray] = []
        self._held = 0

    def add(self, keys: np.ndarray, weights: np.ndarray | None = None) -> None:
        keys, place = np.unique(keys, return_inverse=True)
        self._keys.append(keys)
        self._sums.append(np.bincount(place, weights).astype(np.int64))
        self._held += len(keys)
        if self._held > 4 * PIECE and len(self._keys) > 1:
            self.all()

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if not self._keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self._keys) > 1:
            keys, place = np.unique(np.concatenate(self._keys), return_inverse=True)
            self._keys, self._sums = [keys], [np.bincount(place, np.concatenate(self._sums)).astype(np.int64)]
            self._held = len(keys) // 2  # so that a large sum is not merged again for every small one
        return self._keys[0], self._sums[0]


def _whole(text: np.ndarray, item: np.ndarray, w: int, q: int, edits: int, low: int) -> tuple[int, int]:
    """The longest runs, with edits and without, of a pair that shares so many q-grams that all its diagonals
    are counted: one shifted sum for each place in the item. The bands retained are those that _scan retains;
    neighbours are aligned together."""
    names, mine = np.unique(_grams(item, q), return_inverse=True)
    hashes = _grams(text, q)
    place = np.searchsorted(names, hashes)
    place[place == len(names)] = 0
    theirs = np.where(names[place] == hashes, place + 1, 0).astype(np.uint32)
    m, n = len(mine), len(theirs)
    unit, width = edits + 1, 2 * (edits + 1) if edits else 1
    # diagonal d is at d + low, so that bands begin at multiples of unit
    counts = np.zeros(low + n + 2 * width, np.int32)
    there = set(np.unique(theirs).tolist())
    for a in range(0, n, 1 << 16):  # parts of the text that stay in a processor's cache
        part = theirs[a : a + (1 << 16)]
        for j in range(m):
            if int(mine[j]) + 1 in there:
                at = low + a - j
                counts[at : at + len(part)] += part == mine[j] + 1
    bands = counts[: len(counts) // unit * unit].reshape(-1, unit).sum(axis=1)
    if edits:
        bands = bands + np.append(bands[1:], 0)
    kept = np.flatnonzero(bands >= max(1, w - q + 1 - q * edits))
    best = exact = 0
    if not len(kept):
        return best, exact
    breaks = np.flatnonzero(np.diff(kept) > 1)
    for x, y in zip(np.append(0, breaks + 1), np.append(breaks, len(kept) - 1)):
        begin, end = int(kept[x]) * unit, int(kept[y]) * unit + width
        for a in range(begin, end, ACROSS):
            across = min(ACROSS + width, end - a)
            if best == len(item) and exact >= min(len(item), int(counts[a : a + across].max()) + q - 1):
                continue  # no longer run is possible here
            got = spans(text, np.zeros(1, int), np.array([len(text)]), [item], np.array([a - low]), across, edits)
            best, exact = max(best, int(got[0][0])), max(exact, int(got[1][0]))
    return best, exact


def _scan(index: Index, texts: list[np.ndarray], w: int, q: int, edits: int) -> Iterator[tuple[int, int, int, int]]:
    """(number of the text, number of the item, longest run with edits, without) of pairs with a run of at least w."""
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if len(texts) else np.zeros(0, int)
    joined = np.zeros(int((sizes + 1).sum()), np.uint32)  # a zero after each text is no item's character
    for s, t in zip(starts, texts):
        joined[s : s + len(t)] = t
    hashes = _grams(joined, q)
    maybe = np.flatnonzero(index.seen[hashes >> np.uint64(64 - _BITS)]) if len(index.grams) else np.zeros(0, int)
    slot = np.searchsorted(index.grams, hashes[maybe])
    slot[slot == len(index.grams)] = 0
    hit = index.grams[slot] == hashes[maybe] if len(maybe) else np.zeros(0, bool)
    maybe, slot = maybe[hit], slot[hit]
    if not len(maybe):
        return
    number = np.searchsorted(starts, maybe, "right") - 1
    inside = maybe + q <= starts[number] + sizes[number]
    maybe, slot, number = maybe[inside], slot[inside], number[inside]
    items = len(index.points)
    low = -(-max(len(p) for p in index.points) // (edits + 1)) * (edits + 1)

    # pairs of a text and an item with too many repeated q-grams in common to list them
    group_size = np.diff(index.group_start)
    grouped = np.flatnonzero(index.group_first[slot + 1] > index.group_first[slot])
    group_times = index.group_first[slot[grouped] + 1] - index.group_first[slot[grouped]]
    weighed = _Counts()
    for part in _pieces(group_times):
        g = _spread(index.group_first[slot[grouped[part]]], group_times[part])
        weighed.add(np.repeat(number[grouped[part]], group_times[part]).astype(np.int64) * items + index.group_item[g], group_size[g])
    pairs, weight = weighed.all()
    lengths = np.array([len(p) for p in index.points])
    whole = pairs[weight > np.maximum(DENSE_LEAST, sizes[pairs // items] * lengths[pairs % items] // DENSE_SHARE)]
    for p in whole:
        z, e = _whole(texts[p // items], index.points[p % items], w, q, edits, low)
        if z >= w:
            yield int(p // items), int(p % items), z, e

    # bands: width e + 1, each hit also counts for the band before
    unit = edits + 1
    span = (int(sizes.max()) + low) // unit + 2
    counted = _Counts()

    def count(number: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> None:
        pair = number.astype(np.int64) * items + item
        if len(whole):
            keep = ~np.isin(pair, whole)
            pair, diagonal = pair[keep], diagonal[keep]
        keys = pair * span + (diagonal + low) // unit + 1
        counted.add(np.concatenate([keys, keys - 1]) if edits else keys)

    times = index.first[slot + 1] - index.first[slot]
    for part in _pieces(times):
        entry = _spread(index.first[slot[part]], times[part])
        count(np.repeat(number[part], times[part]), index.item[entry], np.repeat(maybe[part] - starts[number[part]], times[part]) - index.at[entry])
    for part in _pieces(group_times):
        hits = grouped[part]
        g, own = _spread(index.group_first[slot[hits]], group_times[part]), np.repeat(hits, group_times[part])
        rare = ~np.isin(number[own].astype(np.int64) * items + index.group_item[g], whole)
        g, own = g[rare], own[rare]
        for some in _pieces(group_size[g]):
            h, k = own[some], group_size[g[some]]
            entry = _spread(index.group_start[g[some]], k)
            count(np.repeat(number[h], k), np.repeat(index.group_item[g[some]], k), np.repeat(maybe[h] - starts[number[h]], k) - index.group_at[entry])
    keys, counts = counted.all()
    keys = keys[counts >= max(1, w - q + 1 - q * edits)]
    if not len(keys):
        return
    pair, band = keys // span, keys % span - 1
    number, item = pair // items, pair % items
    width = 2 * unit if edits else 1
    for a in range(0, len(keys), 512):
        part = slice(a, a + 512)
        n = number[part]
        got = spans(joined, starts[n], starts[n] + sizes[n], [index.points[i] for i in item[part]], band[part] * unit - low, width, edits)
        for x, y, z, e in zip(n, item[part], *got):
            if z >= w:
                yield int(x), int(y), int(z), int(e)


def _search(shared, w: int, q: int, edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        reach = max((len(p) for p in index.points), default=0) + edits

        def found(held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            best: dict[tuple[int, int], tuple[int, int]] = {}
            for n, i, z, e in _scan(index, [t for _, t in held], w, q, edits):
                at = held[n][0], index.ids[i]
                before = best.get(at, (0, 0))
                best[at] = max(before[0], z), max(before[1], e)
            rows = [(*at, *runs) for at, runs in best.items()]
            kinds = {"doc_id": pa.int64(), "item_id": pa.int64(), "matched": pa.int32(), "exact": pa.int32()}
            return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds.values())], list(kinds))

        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                points = folded(text.as_py())
                for a in range(0, max(len(points) - reach, 1), AT_ONCE):  # a very long text in overlapping parts
                    part = points[a : a + AT_ONCE + reach]
                    if len(part) < w - edits:
                        continue
                    held.append((key, part))
                    size += len(part)
                    if size >= AT_ONCE:
                        yield found(held)
                        held, size = [], 0
        if held:
            yield found(held)

    return run


def leaks(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, q: int = Q, edits: int = 0) -> DataFrame:
    """doc_id, item_id, matched, exact: pairs where at least window consecutive item characters stand in
    the text with at most that many edits; matched is the longest such run, exact the longest without edits
    in the bands that were aligned. A run of window characters without edits is always among them.

    items: item_id and text, held-out material that is small beside the corpus. It is read to the driver
    and broadcast in blocks of at most ITEM_GRAMS characters; every block is searched in all texts, so
    nothing hangs on its size. Texts and items are compared after NFC, lower-casing and removal of
    everything but letters and digits; shorter ones than window, nulls and empty ones are never found.
    A pair comes out once. edits must leave a positive q-gram bound: window - q + 1 > q * edits.
    """
    if window - q + 1 - q * edits < 1:
        raise ValueError("the q-gram bound is not positive: make q or edits smaller")
    spark = docs.sparkSession
    blocks: list[tuple[list[int], list[str]]] = [([], [])]
    room = ITEM_GRAMS
    for row in items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        if room < len(row[1]) and blocks[-1][0]:
            blocks.append(([], []))
            room = ITEM_GRAMS
        blocks[-1][0].append(row[0])
        blocks[-1][1].append(row[1])
        room -= len(row[1])
    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long"), text)
    parts = None
    for ids, texts in blocks:
        shared = spark.sparkContext.broadcast(Index.of(ids, texts, q))
        part = rows.mapInArrow(_search(shared, window, q, edits), "doc_id long, item_id long, matched int, exact int")
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("exact").alias("exact"))
