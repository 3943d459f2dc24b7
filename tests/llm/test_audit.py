"""The filter interaction audit against a loop over whole texts and all orders."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from eligo.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, mask string, n int"


def fails(text):
    w = WORD.findall(text)
    found = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), any(c in "#$%&*|" for c in text))
    return {f for f, bad in zip("ABCD", found) if bad}


def brute(rows, labels):
    least, out, shapley = {}, {}, Counter()
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, p in rows:
        copy = {"E"} if i is not None and i > least[t or ""] else set()
        marks = [(q, x) for k, q, x in labels if k == i and k is not None]
        docs.append((p or "", fails(t or "") | copy, any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)))
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [d for d in own if f in d[1] and not d[1] & before]
                shapley[part, f] += len(gone)
                kept = sum(not d[1] & (before | {f}) for d in own)
                out[part, "".join(order), k + 1] = (kept, len(gone), sum(f in d[1] and bool(d[1] & before) for d in own), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone))
    return {key: (*v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def held(spark, tmp_path, rows, labels, files=6, **more):
    """``rows`` in files that are read one after the other, the last first."""
    at, size = str(tmp_path / "documents.parquet"), -(-len(rows) // files)
    for k in range(0, len(rows), size):
        spark.createDataFrame([(*r, "clash", 1) for r in rows[k : k + size]], SCHEMA).coalesce(1).write.mode("append").parquet(at)
    counts = audit.counters(spark, at, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), **more)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in audit.audited(counts).collect()}
    assert got == brute(rows, labels)
    return got


def some_rows(n, seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "few words", "UPPER CASE " * 30, "same " * 80, "a # b " * 40, "É" * 9] + [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(60)) for _ in range(20)]
    rows = [(rng.choice([k, k, k, rng.randint(0, n), None]), rng.choice(texts), rng.choice(["x", "y", None, ""])) for k in range(n)]
    return rows, [(rng.randint(0, n), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n // 2)] + [(None, 1, 1)]


@pytest.mark.parametrize("order", ["ascending", "descending", "mixed"])
def test_every_order_of_arrival(spark, tmp_path, order):
    rows, labels = some_rows(240, 1)
    if order != "mixed":
        rows.sort(key=lambda r: (r[0] or 0), reverse=order == "descending")
    held(spark, tmp_path, rows, labels, batches=6)


def test_large_groups_and_joined_labels(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(audit, "BROADCAST_LABELS", 0)
    monkeypatch.setattr(audit, "GROUP_ROWS", 7)
    monkeypatch.setattr(audit, "DISK_ROWS", 1)
    copy = " ".join(f"w{k}" for k in range(60))
    rows = [(k, copy, f"s{k % 3}") for k in range(900, 300, -1)] + [(None, copy, "s0")] * 50 + [(301, copy, "s9")] * 3 + [(5, "A long text. " * 20_000, "s1")]
    held(spark, tmp_path, rows, [(k, k % 2, k % 3 == 0 and 1 or 0) for k in range(300, 900, 7)], files=4, batches=4)


def test_one_file_and_no_rows(spark, tmp_path):
    rows, labels = some_rows(30, 2)
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    frame.toPandas().to_parquet(str(tmp_path / "one.parquet"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in audit.audited(audit.counters(spark, str(tmp_path / "one.parquet"), marks)).collect()}
    assert got == brute(rows, labels)
    frame.limit(0).write.parquet(str(tmp_path / "none.parquet"))
    assert audit.audited(audit.counters(spark, str(tmp_path / "none.parquet"), marks)).count() == 0


def test_session_keeps_its_state_store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with audit.on_disk(spark, 10**9):
        assert "RocksDB" in spark.conf.get(name)
    with audit.on_disk(spark, 1_000):
        assert spark.conf.get(name) == before
    assert spark.conf.get(name) == before
