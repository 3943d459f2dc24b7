"""Importance resampling against a loop over whole texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eligo.llm import resample

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, weight string"


def buckets(text, size):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % size for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def brute(rows, target, size=10_000, percent=5, least=20):
    """Counter of (doc_id, n_features, weight, score) and the list of those drawn, in order."""
    raw, want = (Counter(b for t in texts for b in buckets(t, size)[0]) for texts in ([t for _, t in rows], target))
    s_all, t_all = raw.total(), want.total()
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1.0) * (s_all + float(size)) / ((raw[b] + 1.0) * (t_all + float(size)))))
    out, able = Counter(), []
    for i, t in rows:
        own, n = buckets(t, size)
        weight = sum(map(gain, own))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        row = (i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
        out[row] += 1
        if n >= least:
            able.append(row)
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return out, able[: percent * len(able) // 100]


def held(got, rows, target, **more):
    found = [tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    want, drawn = brute(rows, target, **more)
    assert Counter(r[:4] for r in found) == want
    ranked = sorted((r[4], r[:4]) for r in found if r[4] is not None)
    assert [k for k, _ in ranked] == list(range(1, len(drawn) + 1))
    assert [(r[0], r[3]) for _, r in ranked] == [(r[0], r[3]) for r in drawn]


def test_crcs_of_joined_texts():
    rng = random.Random(1)
    for n in (0, 1, 5, 63, 64, 65, 200, 100_000):
        a, b = rng.randbytes(rng.randint(0, 300)), rng.randbytes(n)
        assert resample.joined(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([n]))[0] == zlib.crc32(a + b)


def test_features():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aB1é日 .,-\n{}\x7f\x00`[Kſ") for _ in range(rng.randint(0, 80))) for _ in range(400)] + ["x" * 300 + " y " + "é" * 90, "", " ", "a"]
    for t in texts:
        own, n = resample.features(t.encode(), 10_000)
        want, words = buckets(t, 10_000)
        assert (sorted(own.tolist()), n) == (sorted(want), words)


def some_rows(n):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(rng.choices(vocabulary[: rng.choice([30, 300])], k=rng.randint(0, 60)))) for k in range(n)]
    rows += [(None, " ".join(vocabulary[:40]))] * 3 + [(7, rows[7][1])] * 5 + [(n, None), (n + 1, ""), (n + 2, "long " * 20_000), (8, "another text of key 8 " * 9)]
    return rows, [" ".join(rng.choices(vocabulary[:30], k=40)) for _ in range(5)] + [None, ""]


def test_against_a_loop(spark):
    rows, target = some_rows(700)
    docs = spark.createDataFrame([(*r, "kept") for r in rows], SCHEMA).repartition(7)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    held(resample.resampled(docs, goal), rows, target)
    held(resample.resampled(docs, goal, percent=100, least_words=1, buckets=64), rows, target, size=64, percent=100, least=1)
    held(resample.resampled(docs, goal.limit(0)), rows, [])


def test_empty(spark):
    goal = spark.createDataFrame([("a b",)], "text string")
    assert resample.resampled(spark.createDataFrame([], SCHEMA), goal).count() == 0
    few = resample.resampled(spark.createDataFrame([(1, "a " * 30, "x")], SCHEMA), goal).collect()
    assert [(r["doc_id"], r["rank"]) for r in few] == [(1, None)]


@pytest.mark.parametrize("shape", ["random", "one value", "sorted"])
def test_cutoff_is_exact(spark, shape, tmp_path):
    rng = np.random.default_rng(8)
    n = 5_000
    k0 = {"random": rng.integers(-500, 500, n), "one value": np.zeros(n, np.int64), "sorted": np.arange(n)}[shape]
    keys = [(int(a), int(b), k) for k, (a, b) in enumerate(zip(k0, rng.integers(0, 40, n)))]
    spark.createDataFrame(keys, "k0 long, k1 long, k2 long").repartitionByRange(5, "k0", "k2").write.parquet(str(tmp_path / "keys"))
    df, keys = spark.read.parquet(str(tmp_path / "keys")), sorted(keys)
    for want in (1, 137, 2_500, n):
        assert resample.cutoff(df, want, last=16) == keys[want - 1]
    assert resample.cutoff(df, 0) is None


def test_ranks_follow_the_order(spark):
    df = spark.range(0, 3_000, 1, 6).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("v"), "id")
    got = [(r["v"], r["id"]) for r in resample.ranked(df, [F.col("v"), F.col("id")]).orderBy("rank").collect()]
    assert got == sorted(got) and len(got) == 3_000
    assert sorted(r["rank"] for r in resample.ranked(df, [F.col("v")]).collect()) == list(range(1, 3_001))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held(resample.op12_importance_resampling(spark, sf), rows, target)
