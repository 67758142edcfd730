"""Near-duplicate texts by a parity-sketch join.

A text is the set of its runs of consecutive characters (tokens). Its parity sketch has a bit for each
hash value that is set if an odd number of tokens hash to it; the Hamming distance of two sketches is
never above the size of the sets' symmetric difference, which for a similarity of at least t is at most
(1 - t) / (1 + t) of the sum of their sizes.

At t = 0.6 that bound is a quarter of the sum, half the tokens of either text if they are of one size. Cut
into one part more than that, of which one must be equal, the plain sketch would have two tokens to a part
and nearly every pair would meet. The pigeonhole join therefore works on a
parity sketch of a min-wise sample: tokens drawn by as many hash functions, four of them XORed into each
of PARTS parts. Texts of similarity s agree in a part with probability s**4, so a pair at the
threshold itself meets with 0.996 and one at 0.7 with 0.99998. Parts meet within a band of sizes only; a
text just above a band's lower end is in the one below too. What meets is tested by its sizes and two
bits of CHECKS further samples, by the full sketch's bound and last exactly.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import cut, shared_dir
from .words import code_points

RUN, SIMILARITY = 5, 0.6
PARTS, IN_PART, CHECKS, WORDS = 40, 4, 26, 16
#: Of CHECKS two-bit samples so many must be equal: 26 * (0.6 + 0.4 / 4) = 18.2 are at the threshold, 3.6 deviations more than this.
AGREE = 9
#: A band of sizes spans so many doublings; sizes go with the samples in steps of a 64th doubling, above bit 2 * CHECKS.
DOUBLINGS, STEPS = 5, 64
#: Rows of parts, and texts, that a task gets; more than MOST_TASKS are not made.
ROWS_A_TASK, TEXTS_A_TASK, MOST_TASKS = 250_000, 20_000, 20_000
#: Digests of texts that a task remembers, so that it sketches one of several copies only.
SEEN = 500_000
#: A part that more than HOT texts share is split among tasks; found by one text in ONE_IN, which only balances the work.
HOT, ONE_IN = 8192, 64
#: Pairs whose ids are broadcast, at most two ids of some 60 bytes each.
BROADCAST_PAIRS = 400_000
#: Characters without meaning here (fixed values): space, tab, CR, LF, no-break and zero-width space.
_GONE = (" ", "\t", "\r", "\n", "\u00a0", "\u200b")

_random = np.random.default_rng(20)
_SAMPLES = PARTS * IN_PART + CHECKS
_FLIP = _random.integers(0, 1 << 32, _SAMPLES, dtype=np.uint64).astype(np.uint32)
_TIMES = (_random.integers(0, 1 << 32, _SAMPLES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ODD = _random.integers(0, 1 << 63, PARTS * IN_PART, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PART = np.arange(PARTS, dtype=np.uint64) << np.uint64(43)
_PAIRS = np.uint64(4) ** np.arange(CHECKS, dtype=np.uint64)
_BAND = np.uint64(0xD6E8FEB86659FD93)


def folded(text: str | None) -> str:
    """The text without space, tab, line ends, no-break and zero-width spaces, in small letters."""
    if not text:
        return ""
    for c in _GONE:  # faster than a translation table
        text = text.replace(c, "")
    return text.lower()


def tokens(text: str, run: int) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of consecutive characters of a folded text."""
    points = code_points(text).astype(np.uint64)
    n = len(points) - run + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = points[:n].copy()
    for j in range(1, run):
        h *= _BASE
        h += points[j : j + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h.sort()
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _samples(h: np.ndarray) -> np.ndarray:
    low = (h >> np.uint64(32)).astype(np.uint32)
    least = None
    for a in range(0, len(low), 2048):
        block = ((low[a : a + 2048, None] ^ _FLIP) * _TIMES).min(axis=0)
        least = block if least is None else np.minimum(least, block)
    return least


def sketch(h: np.ndarray, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Full sketch (WORDS longs), keys of the parts in each band of sizes, and the packed check samples with
    the size, of distinct token hashes."""
    parity = np.bincount((h & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    full = np.packbits(parity.astype(np.uint8)).view("<i8")
    least = _samples(h)
    mixed = least[: PARTS * IN_PART].astype(np.uint64) * _ODD
    mixed ^= mixed >> np.uint64(29)
    parts = np.bitwise_xor.reduce((mixed * _BASE).reshape(PARTS, IN_PART), axis=1)
    checks = int((((least[PARTS * IN_PART :] >> np.uint32(7)) & np.uint32(3)).astype(np.uint64) * _PAIRS).sum())
    keys = [((parts ^ np.uint64(band) * _BAND) >> np.uint64(21)) | _PART for band in bands(len(h), similarity)]
    return full, np.concatenate(keys), checks | int(math.log2(len(h)) * STEPS) << 2 * CHECKS


def bands(n: int, similarity: float) -> list[int]:
    """The bands of sizes of a set of n tokens. Of two sets whose sizes differ by no more than the similarity
    allows, the smaller one's band is one of the larger one's."""
    own = (n.bit_length() - 1) // DOUBLINGS
    return [own, own - 1] if own and math.ceil(n * similarity - 1e-9) < 1 << own * DOUBLINGS else [own]


def _lists(rows: list[np.ndarray], there: list[bool]) -> pa.Array:
    """Lists of longs, null where there is none; rows are those that are there."""
    values = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
    widths = np.zeros(len(there), np.int64)
    widths[there] = [len(r) for r in rows]
    ends = np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=pa.array(~np.array(there, bool)))


def _sketches(run: int, similarity: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            ids, digests, rids, sizes, checks = [], [], [], [], []
            fulls, parts, first = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                flat = folded(text)
                if len(flat) < run:
                    continue
                digest = hashlib.md5(flat.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
                ids.append(key)
                digests.append(digest)
                rids.append(int.from_bytes(digest[:8], "big") >> 1)
                if digest in seen:
                    sizes.append(None), checks.append(None), first.append(False)
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(digest)
                h = tokens(flat, run)
                full, keys, check = sketch(h, similarity)
                sizes.append(len(h)), fulls.append(full), parts.append(keys), first.append(True), checks.append(check - (1 << 64) if check >> 63 else check)
            yield pa.record_batch(
                [pa.array(ids, pa.string()), pa.array(digests, pa.binary()), pa.array(rids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(checks, pa.int64()), _lists(fulls, first), _lists(parts, first)],
                ["id", "digest", "rid", "n", "checks", "full", "parts"],
            )

    return work


def _meet(a: DataFrame, b: DataFrame, on: list[str], similarity: float) -> DataFrame:
    """ra, rb: pairs that share a part, sizes near enough and enough of the check samples."""
    a, b = a.alias("a"), b.alias("b")
    differ = F.col("a.checks").bitwiseXOR(F.col("b.checks")).bitwiseAND(F.lit((1 << 2 * CHECKS) - 1))
    sizes = [F.shiftrightunsigned(f"{s}.checks", 2 * CHECKS) for s in "ab"]
    sized = F.abs(sizes[0] - sizes[1]) <= math.ceil(-math.log2(similarity) * STEPS) + 1
    # of each two bits: equal or not
    unequal = F.bit_count(differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    same = reduce(lambda x, y: x & y, (F.col(f"a.{c}") == F.col(f"b.{c}") for c in on))
    return a.join(b, same).where((F.col("a.rid") < F.col("b.rid")) & sized & (unequal <= CHECKS - AGREE)).select(F.col("a.rid").alias("ra"), F.col("b.rid").alias("rb"))


#: Token sets of texts that a task keeps while it verifies; a cluster's texts come again and again.
SETS = 512


def _verify(run: int, similarity: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(SETS)
        def runs(text: str) -> frozenset[str]:
            flat = folded(text)
            return frozenset(flat[i : i + run] for i in range(len(flat) - run + 1))

        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                one, other = runs(a), runs(b)
                both = len(one & other)
                keep.append(both >= similarity * (len(one) + len(other) - both) - 1e-9)
            yield pa.record_batch([batch.column(0), batch.column(1)], ["da", "db"]).filter(pa.array(keep, pa.bool_()))

    return work


class NearDuplicates:
    """Links between texts whose similarity (Jaccard, of runs of characters) is at least similarity.

    df: id and text; an id must not stand with two texts. Texts without a run of that length, nulls and empty ones among them, are linked with
    nothing. Copies (equal folded texts) are sketched and compared once. links holds pairs of digests,
    members the ids of each digest; pairs() expands them, classes() doesn't.
    """

    def __init__(self, df: DataFrame, id: str, text: str, *, run: int = RUN, similarity: float = SIMILARITY) -> None:
        spark = df.sparkSession
        source = df.where(F.col(id).isNotNull()).select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"))
        at = f"{shared_dir(spark)}/neardup-{uuid.uuid4().hex}"
        source.mapInArrow(_sketches(run, similarity), "id string, digest binary, rid long, n int, checks long, full array<long>, parts array<long>").write.parquet(at)
        sketched = spark.read.parquet(at)

        firsts = sketched.where("parts IS NOT NULL")
        texts, parts = firsts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("parts")), F.lit(0))).first()
        tasks = lambda rows, each: min(MOST_TASKS, rows // each + 1)
        rows = firsts.select(F.explode("parts").alias("part"), "rid", "checks").repartition(tasks(parts, ROWS_A_TASK), "part").groupBy("part", "rid").agg(F.first("checks").alias("checks"))
        hot = cut(
            firsts.where(F.col("rid") % ONE_IN == 0).select(F.explode("parts").alias("part"), "rid").distinct().groupBy("part")
            .agg(F.ceil(F.count(F.lit(1)) * ONE_IN / HOT).cast("int").alias("salts")).where("salts > 1")
        )
        met = _meet(rows, rows, ["part"], similarity)
        if not hot.isEmpty():
            warm = rows.join(hot, "part")
            left = warm.withColumn("salt", F.pmod(F.xxhash64("rid"), F.col("salts")).cast("int"))
            right = warm.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            cold = rows.join(hot, "part", "left_anti")
            met = _meet(cold, cold, ["part"], similarity).unionByName(_meet(left, right, ["part", "salt"], similarity))
        met = met.distinct()

        # one shuffle serves the removal of copies and both joins
        whole = firsts.select("rid", "digest", "id", "n", "full").repartition(tasks(texts, TEXTS_A_TASK), "rid").groupBy("rid", "digest").agg(F.min(F.struct("id", "n", "full")).alias("x")).select("rid", "digest", "x.*")
        left, right = (whole.select(*[F.col(c).alias(f"{c}{s}") for c in ("id", "digest", "n", "full")], F.col("rid").alias(f"r{s}")) for s in "ab")
        apart = F.aggregate(F.zip_with("fulla", "fullb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        bound = F.lit((1 - similarity) / (1 + similarity)) * (F.col("na") + F.col("nb")) + F.lit(1e-9)
        sized = F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(similarity) - F.lit(1e-9)
        near = cut(met.join(left, "ra").join(right, "rb").where(sized & (apart <= bound)).select("ida", "idb", "digesta", "digestb"))
        # nothing reads the sketches any more
        self.members = cut(sketched.select("id", "digest"))
        folder = spark._jvm.org.apache.hadoop.fs.Path(at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

        wanted = near.select(F.col("ida").alias("id")).unionByName(near.select(F.col("idb").alias("id"))).distinct()
        # few ids go to the texts, many meet them in a shuffle
        texts = source.join(F.broadcast(wanted) if near.count() <= BROADCAST_PAIRS else wanted, "id", "left_semi")
        pairs = near.join(texts.select(F.col("id").alias("ida"), F.col("text").alias("texta")), "ida").join(texts.select(F.col("id").alias("idb"), F.col("text").alias("textb")), "idb")
        self.links = pairs.select("digesta", "digestb", "texta", "textb").mapInArrow(_verify(run, similarity), "da binary, db binary")

    def pairs(self) -> DataFrame:
        """a, b: every pair of linked ids, a before b in byte order, copies included."""
        m = self.members
        one, two = m.select(F.col("id").alias("x"), F.col("digest").alias("da")), m.select(F.col("id").alias("y"), F.col("digest").alias("db"))
        across = self.links.join(one, "da").join(two, "db").select("x", "y")
        copies = one.join(two, F.col("da") == F.col("db")).where("x < y").select("x", "y")
        return across.unionByName(copies).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    def classes(self) -> DataFrame:
        """id, class_id, links: the class (the digest of its least member) and number of linked ids of every
        id that has a run of characters; copies are counted, not paired."""
        links = cut(self.links)  # three uses, verified once
        sizes = self.members.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
        hexed = links.select(F.hex("da").alias("a"), F.hex("db").alias("b"))
        roots = components(hexed)
        ends = links.unionByName(links.select(F.col("db").alias("da"), F.col("da").alias("db")))
        others = ends.join(sizes.withColumnRenamed("digest", "db"), "db").groupBy("da").agg(F.sum("copies").alias("others")).withColumnRenamed("da", "digest")
        per = sizes.join(others, "digest", "left").select("digest", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"), F.hex("digest").alias("node"))
        per = per.join(roots, "node", "left").select("digest", "links", F.coalesce("root", "node").alias("class_id"))
        return self.members.join(per, "digest").select("id", "class_id", "links")
