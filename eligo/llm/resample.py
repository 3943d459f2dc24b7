"""Importance resampling towards a target distribution: hashed n-grams, array-scored weights, exact top-k selection.

Words, word pairs and word triples fall into buckets by CRC-32. Each bucket's gain is the log ratio of its smoothed
shares in the target and in the corpus; a document's weight is the sum of its features' gains, and its score adds a
Gumbel draw that only its key decides. The highest scores are the sample.

CRCs of pairs and triples are not computed over their bytes: the CRC of two joined texts follows from those of the parts
by a linear map that only the second part's length decides, so words are hashed once and the rest are table lookups over
numpy arrays.

The cutoff is found by weighted medians of medians. Scored rows are narrow rows of a written table; each partition holds
its remaining keys against the current pivot and returns, for both sides, how many it has and their median. The driver
picks a side and takes the median of these medians, weighted by the partitions' counts, as next pivot: at least a
quarter of what remains lies on either side of it. Keys (score, doc_id, row number) are all different, so the last
round ends at the exact key of the last winner. Rows out of reach are left behind in a smaller written table whenever
half of them are. Only one narrow row per partition and, once at most ``last`` keys remain, these keys reach the driver.
Winners are then sorted; the others need not move.

Defined results: null and empty texts have no features, weight 0 and a score; a null key is drawn for like the text
``42:``, and comes after all others in a tie; repeated rows each have their own place, in any order; a very long text is
held by one task; extra columns are not read; an empty table gives no rows, and an empty target leaves gains that favour
rare buckets alike.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import table, text_of, written

#: Bytes of a text as they count: A-Z as a-z; ASCII bytes that are no letter or digit end a word.
LETTERS = bytes(ord(" ") if b < 128 and not chr(b).isalnum() else ord(chr(b).lower()) if b < 128 else b for b in range(256))
#: Lengths up to which a linear map has a table of its own.
SHORT = 64
CACHE_WORDS, CACHE_LENGTH = 400_000, 64
FEATURES = "id long, n_features long, n_words long, weight long, score long"


def _after_zeros(crc: np.ndarray, n: int) -> np.ndarray:
    """What ``n`` zero bytes make of CRC registers without the first and last inversion."""
    step = ZERO
    crc = crc.astype(np.uint32)
    while n:
        if n & 1:
            crc = _applied(step, crc)
        step = _squared(step)
        n >>= 1
    return crc


def _applied(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map, as four tables of 256, on registers."""
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


def _squared(tables: np.ndarray) -> np.ndarray:
    return np.stack([_applied(tables, t) for t in tables])


def _one_zero() -> np.ndarray:
    """The map of one zero byte: a register's low byte goes through the CRC table, the others move down."""
    low = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)  # linear part of the table
    byte = np.arange(256, dtype=np.uint32)
    return np.stack([low, byte, byte << 8, byte << 16])


ZERO = _one_zero()


def _tables(most: int) -> np.ndarray:
    """[length][byte place][byte]: the maps of 0 to ``most`` - 1 zero bytes."""
    byte = np.arange(256, dtype=np.uint32)
    out = [np.stack([byte, byte << 8, byte << 16, byte << 24])]
    for _ in range(1, most):
        out.append(np.stack([_applied(ZERO, t) for t in out[-1]]))
    return np.stack(out)


MAPS = _tables(SHORT)


def joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of texts followed by others, from both CRCs and the second texts' lengths in bytes."""
    near = np.minimum(length, SHORT - 1)
    out = MAPS[near, 0, first & 255] ^ MAPS[near, 1, first >> 8 & 255] ^ MAPS[near, 2, first >> 16 & 255] ^ MAPS[near, 3, first >> 24]
    for n in np.unique(length[length >= SHORT]):
        rows = length == n
        out[rows] = _after_zeros(first[rows], int(n))
    return out ^ second


class WordCrcs(dict):
    """CRC-32 of words in the low half, their length in the high half; a bounded memory."""

    def __missing__(self, word: bytes) -> int:
        h = zlib.crc32(word) | len(word) << 32
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = h
        return h


WORDS = WordCrcs()
BLANK = np.uint32(zlib.crc32(b" "))


def features(text: bytes, buckets: int, width: int = 3) -> tuple[np.ndarray, int]:
    """(buckets of all runs of 1 to ``width`` words, number of words)."""
    words = text.translate(LETTERS).split()
    if not words:
        return np.empty(0, np.uint32), 0
    packed = np.fromiter(map(WORDS.__getitem__, words), np.int64, len(words))
    crc, length = (packed & 0xFFFFFFFF).astype(np.uint32), packed >> 32
    spaced = joined(np.full(len(crc), BLANK), crc, length)  # of a blank and the word
    runs, out = crc, [crc]
    for k in range(1, min(width, len(words))):
        runs = joined(runs[:-1], spaced[k:], length[k:] + 1)
        out.append(runs)
    return np.concatenate(out) % np.uint32(buckets), len(words)


def bucket_counts(docs: DataFrame, buckets: int, text: str = "text") -> np.ndarray:
    """How many features of all rows fall into each bucket. A task counts into one array; only the sums, ``buckets``
    numbers, reach the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch.column(0):
                total += np.bincount(features(t.as_py(), buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    rows = docs.select(text_of(docs, text).cast("binary").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of (t + 1)(S + B) / ((s + 1)(T + B))) for each of B buckets."""
    size, s_all, t_all = float(len(raw)), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size)))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def draw(key: int | None) -> int:
    """The Gumbel draw of a key, in thousandths."""
    h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_features, n_words, weight, score of every row."""
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                at, n = features(t.as_py(), buckets)
                weight = int(gain[at].sum())
                rows.append((i, len(at), n, weight, weight + draw(i)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "n_features", "n_words", "weight", "score"])

    return docs.select(docs[key].cast("long").alias("id"), text_of(docs, text).cast("binary").alias("text")).mapInArrow(run, FEATURES)


#: Keys as three numbers, the better the smaller: score turned round, doc_id (null last), row number.
KEY = ("k0", "k1", "k2")


def _order(keys: np.ndarray) -> np.ndarray:
    return np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))


def _below(keys: np.ndarray, pivot) -> np.ndarray:
    """Which keys come before ``pivot``."""
    a, b, c = (keys[:, j] for j in range(3))
    return (a < pivot[0]) | (a == pivot[0]) & ((b < pivot[1]) | (b == pivot[1]) & (c < pivot[2]))


def _median(keys: np.ndarray) -> list:
    return keys[_order(keys)[(len(keys) - 1) // 2]].tolist() if len(keys) else [0, 0, 0]


def _inside(low, high):
    """Condition: the key is at least ``low`` and before ``high`` (None: no bound)."""
    before = lambda p: F.expr(f"struct({', '.join(KEY)})") < F.struct(*(F.lit(int(x)).cast("long").alias(k) for k, x in zip(KEY, p)))
    return (~before(low) if low else F.lit(True)) & (before(high) if high else F.lit(True))


def cutoff(keys: DataFrame, want: int, last: int = 4_096) -> tuple | None:
    """The key with exactly ``want`` keys up to and with it; None if ``want`` is 0. ``keys``: k0, k1, k2, all different, a
    written table of at least ``want`` rows."""
    if want <= 0:
        return None

    def run(pivot):
        def sides(batches):
            parts = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], 1) for b in batches if b.num_rows]
            if parts:
                own = np.concatenate(parts)
                low = _below(own, pivot) if pivot else np.zeros(len(own), bool)
                row = [v for side in (own[low], own[~low]) for v in (len(side), *_median(side))]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], names=[f"{s}{n}" for s in "ab" for n in ("n", *KEY)])

        return sides

    shape = ", ".join(f"{s}{n} long" for s in "ab" for n in ("n", *KEY))
    low = high = pivot = None
    held = None  # rows of ``keys``
    while True:
        found = np.array(keys.filter(_inside(low, high)).select(*KEY).mapInArrow(run(pivot), shape).collect(), np.int64).reshape(-1, 8)
        below, above = found[:, 0].sum(), found[:, 4].sum()
        held = held or int(below + above)
        if pivot is not None:
            if want <= below:
                found, high, left = found[:, :4], pivot, below
            else:
                found, low, left, want = found[:, 4:], pivot, above, want - int(below)
        else:
            found, left = found[:, 4:], above
        if left <= last:
            rest = np.array(keys.filter(_inside(low, high)).select(*KEY).collect(), np.int64).reshape(-1, 3)
            return tuple(rest[_order(rest)[want - 1]].tolist())
        found = found[found[:, 0] > 0]
        found = found[_order(found[:, 1:])]
        at = int(np.searchsorted(np.cumsum(found[:, 0]), (left + 1) // 2))
        pivot = tuple(found[at, 1:].tolist())
        if 2 * left <= held:
            keys, held = written(keys.filter(_inside(low, high)).select(*KEY), "remaining"), int(left)


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with rank 1, 2, 3... : sorted by ranges, numbered within a partition, moved on by what stands before."""
    placed = written(rows.orderBy(*order).withColumn("place_", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("place_", 33)
    sizes = sorted(placed.groupBy(part.cast("int").alias("part")).count().collect())
    starts, before = [], 0
    for p, n in sizes:
        starts.append((p, before))
        before += n
    starts = rows.sparkSession.createDataFrame(starts or [(0, 0)], "part_ int, before_ long")
    out = placed.withColumn("part_", part.cast("int")).join(F.broadcast(starts), "part_")
    return out.withColumn("rank", F.col("before_") + F.col("place_").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("part_", "before_", "place_")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = 10_000, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_features, weight, score, rank of every row: of the rows with at least ``least_words`` words the
    ``percent`` % with the highest scores have a rank."""
    gain = gains(bucket_counts(docs, buckets, text), bucket_counts(target, buckets, text))
    rows = scored(docs, gain, key, text).withColumn("k2", F.monotonically_increasing_id())
    rows = rows.withColumns({"k0": -F.col("score"), "k1": F.coalesce("id", F.lit((1 << 63) - 1))})
    rows = written(rows, "scored")
    able = F.col("n_words") >= least_words
    last = cutoff(rows.filter(able).select(*KEY), percent * rows.filter(able).count() // 100)
    won = able & ~_inside(last, None) | (F.col("k0") == last[0]) & (F.col("k1") == last[1]) & (F.col("k2") == last[2]) if last else F.lit(False)
    out = [F.col("id").alias(key), "n_features", "weight", "score"]
    winners = ranked(rows.filter(won), [F.col(k) for k in KEY])
    return rows.filter(~won).select(*out, F.lit(None).cast("long").alias("rank")).unionAll(winners.select(*out, "rank"))


def op12_importance_resampling(spark, sf_dir) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
