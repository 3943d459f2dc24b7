"""The corpus operators against brute force, exact round trips and held-out accuracy, on small and awkward rows."""

import base64
import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark import SparkFiles
from pyspark.sql import functions as F

from eligo.llm import bpe, chat, fingerprints, graph, licenses, neardup, packing, quality, toxicity, urlfilter, warc
from eligo.llm.common import fresh_dir, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, schema=DOCS):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def words(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Omega.", "x", "éé", "7", "the", "of"]) + str(rng.randint(0, 400)) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    long_ = words(4000, 1)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (6, words(60, 2)), (7, words(60, 2) + " end"), (8, long_), (9, long_), (9, long_), (None, words(40, 3)), (11, "É\u00a0b\x1cc </s>[INST] x\n\nÉ"), (12, "A a A a"), (13, None)]
    return rows, frame(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


# -- 1 ---------------------------------------------------------------------------------------------------------------
def test_fingerprints_edit_and_order(spark, awkward):
    rows, df = awkward
    got = fingerprints.edited_fingerprints(df).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = Counter()
    for k, r in enumerate(order):
        t, n = r[1] or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 3
        want[(r[0], len(t), hashlib.sha256((t[: len(t) - m] + n[:m]).encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    by = defaultdict(set)
    text_of = defaultdict(set)
    for i, t, *_ in rows:
        text_of[i].add(t or "")
    for r in got:
        by[r["fingerprint"]].add(tuple(sorted(next(iter(text_of[r["doc_id"]])).split("\n"))))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(v) == 1 for v in by.values()) and len(by) == len({x for v in by.values() for x in v})


def test_fingerprints_many_blocks(spark):
    ids = random.Random(4).sample(range(10**12), 300)
    df = frame(spark, [(i, f"text {i}") for i in ids])
    dealt, window = fingerprints.in_order(df.select("doc_id", "text"), block_rows=7)
    got = dealt.withColumn("next", F.lead("doc_id").over(window)).filter("not guest")
    order = sorted(ids, reverse=True)
    assert {r["doc_id"]: r["next"] for r in got.collect()} == dict(zip(order, [*order[1:], order[0]]))


def spark_hash(*values, seed=42):
    """Spark's xxhash64 of strings and whole numbers (4 bytes where given as a pair with 4), unsigned."""
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<Q", v % 2**64)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def test_fingerprints_against_loops(spark, awkward):
    texts = sorted({t or "" for _, t in awkward[0]} | {"a b. c!\nd", "\n\n", "x. x. x.", "é? ü"}, key=len)[:14]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", fingerprints.fingerprint(F.col("text")).alias("f")).collect()
    for r in got:
        exact, marks = [0] * 16, [0] * 65
        for p in r["text"].split("\n"):
            d = hashlib.sha256(p.encode()).hexdigest()
            exact = [(x + spark_hash(d, (i, 4)) % 2**32) % 2**32 for i, x in enumerate(exact)]
        for sentence in filter(None, re.split(r"\n|(?<=[.!?]) ", r["text"])):
            h = [spark_hash(sentence), spark_hash(sentence, (1, 4))]
            for i in range(64):
                low, high = h[i // 32] >> (i % 32) & 1, h[i // 32] >> (i % 32 + 32) & 1
                marks[i] += low + (high << 32)
            marks[64] += 1
        assert r["f"]["exact"] == exact and r["f"]["marks"] == marks


def test_fingerprint_algebra(spark):
    row = spark.createDataFrame([("a b. c\nd e.\n", "b d\na")], "t string, s string").select(
        fingerprints.fingerprint(F.lit("one\ntwo. three\nfour")).alias("f"), fingerprints.fingerprint(F.lit("four\none\ntwo. three")).alias("g"), fingerprints.fingerprint(F.lit("one\nfour")).alias("h")
    )
    row = row.select("f", "g", fingerprints.inserted(F.col("h"), F.lit("two. three")).alias("i"), fingerprints.deleted(F.col("f"), F.lit("two. three")).alias("d"), "h", fingerprints.likeness(F.col("f"), F.col("g")).alias("same"))
    r = row.first()
    assert r["f"] == r["g"] == r["i"] and r["d"] == r["h"] and r["same"] == 1


def test_likeness_follows_shared_sentences(spark):
    a = [f"sentence number {k} of the first." for k in range(60)]
    b = [f"sentence number {k} of the second." for k in range(60)]
    rows = [(" ".join(a), " ".join(a[:n] + b[n:]), n / 60) for n in (0, 15, 30, 45, 60)]
    got = spark.createDataFrame(rows, "a string, b string, w double").select("w", fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("x")).collect()
    assert all(abs(r["w"] - r["x"]) < 0.25 for r in got)


# -- 2 ---------------------------------------------------------------------------------------------------------------
def base_rules(t):
    w = SPACES.findall(t)
    lines = [x for x in t.split("\n") if SPACES.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    cover = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover), failed


def score(t, ratio, spark):
    df = spark.createDataFrame([(t,)], "text string")
    return quality.hashed(df).select(ratio.score(quality.ngrams(len(ratio.weights))).alias("s")).first()["s"]


def test_quality_base_rules(spark, awkward):
    rows, df = awkward
    extra = [(20, "a b c d e f g h i j " * 3), (21, "p q r s t u v w " + words(30, 9) + " p q r s t u v w"), (22, "x#*\nx#*\n\n \nx"), (23, "y " * 50)]
    df = df.unionByName(frame(spark, extra))
    got = quality.judged(df, frame(spark, [], "doc_id long, quality int, toxic int")).select("doc.doc_id", *quality.FIGURES).collect()
    want = Counter((r[0], *base_rules(r[1] or "")) for r in [*rows, *extra])
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    assert all(r["kept"] == (not r["base_failed"]) for r in got)


def test_quality_verdicts(spark, empty):
    rng = random.Random(8)
    good, bad = [f"w{k}" for k in range(80)], [f"w{k}$$$" for k in range(80)]
    rows, labels = [], []
    for i in range(300):
        clean = i % 4 > 0
        rows.append((i, " ".join(rng.choices(good if clean else bad, k=60)), "en", "s", 1))
        labels.append((i, int(clean), 0))
    docs = frame(spark, rows, DOCS.replace("lang", "h1").replace("source", "words")).repartition(3)
    labels = frame(spark, labels, "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality.accepted(docs, labels, buckets=512).collect()}
    wrong = [i for i in range(300) if (i in kept) != (i % 4 > 0)]
    assert len(wrong) <= 3
    ratio = quality.fit(docs.select("doc_id", "text"), labels, 512)
    grams = Counter()
    weights = ratio.weights
    df = quality.hashed(docs.select("doc_id", "text").filter("doc_id = 1")).select(quality.ngrams(512).alias("g"))
    g = df.first()["g"]
    assert len(g) == 119 and score(rows[1][1], ratio, spark) == pytest.approx(sum(weights[b] for b in g) / 119)
    assert not grams and quality.accepted(empty, labels).count() == 0


def test_quality_weights_and_threshold_against_loops(spark):
    rng = random.Random(21)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(60)] + ([f"b{k}" for k in range(30)] if i % 3 else []), k=rng.randint(21, 40)))) for i in range(150)]
    docs, labels = frame(spark, rows).select("doc_id", "text"), frame(spark, [(i, int(i % 3 == 0), 0) for i in range(0, 150, 2)], "doc_id long, quality int, toxic int")
    size, ratio = 64, quality.fit(docs, labels, 64)
    fits = {r["key"]: (r["good"], r["fit"]) for r in quality.sample_keys(labels, 20_000).collect()}

    def grams(text):
        h = [spark_hash(w) for w in text.split()]
        signed = lambda x: x - 2**64 if x >= 2**63 else x
        return [signed(x) % size for x in h + [spark_hash(a, b) for a, b in zip(h, h[1:])]]

    raw, good = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if fits.get(i) == (1, True):
            good.update(grams(t))
    part = lambda c, b: math.log((c[b] + 0.5) / (sum(c.values()) + 0.5 * size))
    assert ratio.weights == pytest.approx([part(good, b) - part(raw, b) for b in range(size)], abs=1e-5)
    scores = {i: sum(ratio.weights[b] for b in grams(t)) / (2 * len(t.split()) - 1) for i, t in rows}
    held = [(scores[i], g) for i, (g, fit) in fits.items() if not fit]
    n = [sum(g == k for _, g in held) for k in (0, 1)]
    cost = lambda cut: 20.0 * sum(x < cut for x, g in held if g) / n[1] + sum(x >= cut for x, g in held if not g) / n[0]
    assert cost(ratio.threshold) <= min(cost(k / 100 - 10) for k in range(2001)) + 1e-9


def test_quality_fit_takes_all_labels_by_both_joins(spark):
    n, size = 60_000, 64
    docs = spark.range(n).selectExpr("IF(id >= 59990, null, id) AS doc_id", "IF(id % 2 = 1, 'a', 'b') AS text")
    labels = spark.range(59_990).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    good = quality.labelled(labels).filter("good = 1 and fit").count()
    assert good > 14_000  # half of the well-labelled rows, not of a sample of 20,000
    want = math.log((good + 0.5) / (good + 0.5 * size)) - math.log((n / 2 + 0.5) / (n + 0.5 * size))
    fits = [quality.fit(docs, labels, size), quality.fit(docs, labels, size, broadcast_keys=0)]
    assert fits[0].weights == fits[1].weights and fits[0].threshold == fits[1].threshold
    assert fits[0].weights[spark_hash("a") % size] == pytest.approx(want, abs=1e-5)


# -- 3 ---------------------------------------------------------------------------------------------------------------
def test_warc_round_trip(spark):
    rows = [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (0, None, "<p>é</p>"), (5, "u\r\nv", None), (4, "http://c", ""), (6, "x", "y" * 300_000), (None, "n", "<p>é</p>"), (8, "r\r\n\r\nt", "a\r\n\r\nb\r\n"), (7, "z", "y" * 300_000)]
    df = frame(spark, rows, "page_id long, url string, html string").repartition(3)
    folder = fresh_dir(spark, "warc")
    index = warc.write(df, folder, archive_bytes=500)
    got = {r["page_id"]: r for r in warc.read(index, folder, payloads=True).collect()}
    first = {}
    for i, _, h in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(h or "", i)
    for i, u, h in rows:
        payload = (h or "").encode()
        r = got[i]
        revisit = i is not None and first[h or ""] != i
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[h or ""]) if revisit else ("response", None))
        assert r["payload"] == ("" if revisit else h or "") and r["url"] == u
    again = warc.write(df.unionAll(df).unionAll(df.filter("page_id = 2")), folder + "d")
    parts = warc.read(again, folder + "d", task_bytes=300)
    assert Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in parts.collect()) == Counter({(i, r["record_type"], r["refers_to"]): 3 if i == 2 else 2 for i, r in got.items()})
    assert parts.rdd.getNumPartitions() > 10
    none = warc.write(df, folder + "b", min_bytes=100)
    assert none.filter("record_type = 'revisit'").count() == 1
    assert warc.read(index.filter("page_id in (1, 6)"), folder).count() == 2
    assert warc.read(warc.write(df.limit(0), folder + "c"), folder + "c").count() == 0


def test_warc_ranges():
    assert warc.ranges([(0, 10), (10, 5), (30, 5), (100, 1)], gap=15, most=40) == [(0, 35, [0, 1, 2]), (100, 101, [3])]
    assert warc.ranges([(0, 10), (10, 50)], gap=5, most=40) == [(0, 10, [0]), (10, 60, [1])]


# -- 4 ---------------------------------------------------------------------------------------------------------------
def test_bpe_equals_the_library(spark, awkward):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    rng = random.Random(2)
    odd = ["".join(rng.choice("abc de\n\t 'sll \u2009é日本語12٣\x1c\x85🙂!?Z") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    odd += ["<|endoftext|>a<|endoftext|><|endoftext|> b", "ab" * 500, " " * 30, "don't we'll"]
    rows = [*awkward[0], *((100 + i, t) for i, t in enumerate(odd))]
    df = frame(spark, rows).select("doc_id", bpe.encode(F.coalesce("text", F.lit(""))).alias("ids")).select("doc_id", "ids", bpe.decode(F.col("ids")).alias("back"))
    want = Counter()
    for i, t, *_ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[(i, tuple(ids), lib.decode(ids, skip_special_tokens=False))] += 1
    assert Counter((r["doc_id"], tuple(r["ids"]), r["back"]) for r in df.collect()) == want
    broken = bpe.coder(path).decode(pa.array([220, 158, 247, 64], pa.int32()), np.asarray([0, 3, 3, 4]))
    assert broken.to_pylist() == [lib.decode(x, skip_special_tokens=False) for x in ([220, 158, 247], [], [64])]


def test_bpe_cuts_every_character_as_the_library_does():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    lib, own = Tokenizer.from_file(path), bpe.TrieBpe(path)
    blocks = ["".join(map(chr, range(k, min(k + 64, 0xD800)))) for k in range(1, 0xD800, 64)]
    texts = [*blocks, *(" a".join(b) for b in blocks), "𝐀𝟏 x😀😀 𝐀b1😀", "a² b½ Ⅷ x'll I'S ___foo _a1b2", "ab²c 3² '²", "'sx 'tx x's x'S"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_bpe_knows_the_library_s_letters_and_numbers():
    """Every character before a contraction, a digit and a comma; with and without an emoji or an added token in the text."""
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    lib, own = Tokenizer.from_file(path), bpe.TrieBpe(path)
    points = [c for c in range(0x32400) if not 0xD800 <= c < 0xE000]
    for form in ("{0}'t{0}1{0},\n", "😀 {0}'t{0}1{0},\n", "<|endoftext|>{0}'t{0}1 {0}\n"):
        texts = [("😀" if form[0] == "😀" else "").join(form.format(chr(c)) for c in points[k : k + 64]) for k in range(0, len(points), 64)]
        if form[0] != "😀":  # the quick pattern, where no character is far
            texts = [t for t in texts if ord(max(t)) < 0x10000] + texts[-600:]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_bpe_of_a_huge_word():
    own = bpe.TrieBpe(tokenizer_path("byte_bpe_50k.json"))
    before = own.memory.held
    ids = np.frombuffer(own.encode(["ab" * 2_000_000 + " c"])[0], "<u4")
    assert own.decode(pa.array(ids.astype(np.int32)), np.asarray([0, len(ids)])).to_pylist() == ["ab" * 2_000_000 + " c"]
    assert own.memory.held - before < 1_000


def test_bpe_keeps_rows_and_columns(spark, empty):
    rows = [(None, None, 5), (1, "a b", 6), (1, "a b", 6), (2, "", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long").select("doc_id", "ids", bpe.encode(F.col("text")).alias("coded"))
    got = Counter((r["doc_id"], r["ids"], r["back"]) for r in df.select("doc_id", "ids", bpe.decode(F.col("coded")).alias("back")).collect())
    assert got == Counter({(None, 5, ""): 1, (1, 6, "a b"): 2, (2, 7, ""): 1})
    assert empty.select(bpe.decode(bpe.encode(F.col("text")))).count() == 0
    nulls = spark.createDataFrame([(None,), ([64],)], "ids array<int>").select(bpe.decode(F.col("ids")).alias("t"))
    assert {r["t"] for r in nulls.collect()} == {None, "a"}


# -- 5 ---------------------------------------------------------------------------------------------------------------
def brute_groups(rows, width, percent):
    sets = []
    for _, t, *_ in rows:
        w = SPACES.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            m = len(sets[a] & sets[b])
            if m and 100 * m >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    out = Counter()
    for own in groups.values():
        keys = [rows[k][0] for k in own if rows[k][0] is not None]
        for at, k in enumerate(own):
            out[(rows[k][0], len(sets[k]), min(keys, default=None), at == 0 if not keys else rows[k][0] == min(keys))] += 1
    return out


def test_near_duplicates(spark, awkward, empty):
    rng = random.Random(5)
    rows = list(awkward[0])
    for g in range(6):
        base = words(80 if g else 3, 50 + g).split()
        for k in range(14):
            t = list(base)
            for _ in range(rng.randint(0, 9)):
                t[rng.randrange(len(t))] = f"n{rng.randint(0, 9999)}"
            rows.append((100 * (g + 1) + k, " ".join(t).upper() if k % 5 == 0 else " ".join(t)))
    df = frame(spark, rows).withColumnRenamed("lang", "component").withColumnRenamed("source", "id").repartition(5)
    for width in (2, 5):
        got = neardup.near_duplicates(df, width=width)
        assert Counter(map(tuple, got.collect())) == brute_groups(rows, width, 80)
    assert neardup.near_duplicates(empty).count() == 0
    alone = neardup.near_duplicates(frame(spark, [(None, "a b c"), (None, "a b c")])).collect()
    assert sorted((r["component_id"], r["kept"]) for r in alone) == [(None, False), (None, True)]


def damaged(text, seed, n=2):
    rng, out = random.Random(seed), text.split()
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randint(0, 999)}"
    return " ".join(out)


def keys_and_texts():
    """Keys with several texts, texts with several keys, null keys, in every order."""
    a, b, c, d = (words(90, 700 + k) for k in range(4))
    rows = [(5, a), (5, b), (7, damaged(b, 1)), (1, c), (2, d), (2, c), (3, "alone"), (None, damaged(d, 2)), (None, damaged(d, 2)), (None, "only without a key " * 9), (None, "only without a key " * 9), (2, c), (9, damaged(c, 3)), (9, damaged(a, 4)), (4, ""), (4, None), (4, "")]
    return [rows, rows[::-1], random.Random(2).sample(rows, len(rows))]


def test_near_duplicates_of_repeated_keys(spark):
    for rows in keys_and_texts():
        got = neardup.near_duplicates(frame(spark, rows), width=2)
        assert Counter(map(tuple, got.collect())) == brute_groups(rows, 2, 80)


def test_near_duplicates_by_every_join(spark, monkeypatch):
    """Wanted keys above the broadcast bound, centres of many pairs."""
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    monkeypatch.setattr(neardup, "MANY_PAIRS", 3)
    base = words(70, 44)
    rows = [(k if k % 9 else None, damaged(base, k)) for k in range(60)] + keys_and_texts()[0]
    got = neardup.near_duplicates(frame(spark, rows).repartition(3), width=2, tile=7)
    assert Counter(map(tuple, got.collect())) == brute_groups(rows, 2, 80)


def test_one_of_each_group(spark):
    for rows in keys_and_texts():
        got = Counter((r["doc_id"], r["text"]) for r in neardup.one_of_each(frame(spark, rows).withColumn("component", F.lit(1))).collect())
        groups = defaultdict(list)
        for k, r in enumerate(rows):
            w = SPACES.findall((r[1] or "").lower())
            groups[k if not w else None].append((r, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
        near, left = [], list(groups.pop(None))
        while left:
            own = [left.pop()]
            for r, s in own:
                own += (more := [x for x in left if 100 * len(s & x[1]) >= 80 * len(s | x[1])])
                left = [x for x in left if x not in more]
            near.append(min((r[0] is None, r[0] or 0) for r, _ in own))
        kept = Counter((i is None, i or 0) for (i, t), n in got.items() for _ in range(n) if (t or "").strip())
        assert kept == Counter(near)
        assert set(got) <= set(rows) and {r for r in rows if not (r[1] or "").strip()} <= set(got) | {(i, {"": None, None: ""}.get(t, t)) for i, t in got}


def test_parity_bound_never_drops_a_link():
    rng = np.random.default_rng(1)
    for n in (3, 40, 400, 3000):
        for _ in range(40):
            a = np.unique(rng.integers(0, 2**64, n, np.uint64))
            keep = a[rng.random(len(a)) > rng.random() * 0.3]
            b = np.unique(np.concatenate([keep, rng.integers(0, 2**64, int(n * rng.random() * 0.2), np.uint64)]))
            if len(b) and len(np.intersect1d(a, b)) * 100 >= 80 * len(np.union1d(a, b)):
                apart = sum((int(x) ^ int(y)).bit_count() for x, y in zip(neardup.parities(a).view(np.uint64), neardup.parities(b).view(np.uint64)))
                assert 180 * max(apart, abs(len(a) - len(b))) <= 20 * (len(a) + len(b))


def test_pairs_at_the_limit_share_a_bucket():
    rng, sketcher = np.random.default_rng(3), neardup.Sketcher(48, 6)
    for n in (1, 2, 5, 9, 40, 400, 1000):
        met = 0
        for _ in range(100):
            same = rng.integers(0, 2**64, max(1, math.ceil(0.8 * n)), np.uint64)
            rest = rng.integers(0, 2**64, n - len(same), np.uint64)  # similarity at least 0.8: the union holds n
            a, b = np.unique(same), np.unique(np.concatenate([same, rest]))
            met += bool((sketcher.keys(a) == sketcher.keys(b)).any())
        assert met == 100, n


def test_near_duplicates_of_one_hot_bucket_in_small_tiles(spark):
    base = words(60, 99).split()
    rows = [(i, " ".join(base[:57] + [f"{i}a", f"{i}b", f"{i}c"])) for i in range(120)] + [(500 + i, " ".join(base[:40] + [f"{i}d"] * 30)) for i in range(60)]
    got = neardup.near_duplicates(frame(spark, rows), width=2, tile=9)
    assert Counter(map(tuple, got.collect())) == brute_groups(rows, 2, 80)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)]
    parent = list(range(500))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


# -- 6 ---------------------------------------------------------------------------------------------------------------
def brute_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    under = lambda name: host == name or host.endswith("." + name)
    fits = [(len(h + p), h + p, v) for h, p, v in urlfilter.RULES if under(h) and path.startswith(p)]
    if fits:
        return (host, path, *max(fits)[1:])
    return host, path, None, "block" if set(host.split(".")[:-1]) & set(urlfilter.JUNK) else "allow"


def test_url_filter(spark):
    urls = [None, "", "no scheme/x", "http://a.ORG/x?y", "http://a.org", "https://m.example.org/es/1", "https://example.org/en/178#t", "http://xexample.org/es/", "ftp://É.com/fr/?q", "http://com/de/x", "http://b.com/DE/", "http://u://v/w", "http://www.cheap-pills.example.net/a", "http://cheap-pills.example.net.x/a", "http://spam-farm.example.org/es/", "http:///p", "x://h?a/b", "http://.org/"]
    # columns that clash with results are replaced, all others stay
    rows = [(i, u, "mine", i) for i, u in enumerate([*urls, *urls])]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, best long").withColumns({c: F.lit("x") for c in ("path", "rule", "verdict", "found", "tail")})
    entries = urlfilter.entry_rows(spark).unionByName(urlfilter.junk_entries(df))
    want = Counter((i, *brute_verdict(u), i, "x") for i, u in enumerate([*urls, *urls]))
    pick = ["page_id", "host", "path", "rule", "verdict", "best", "found"]
    for options in ({}, {"most_bytes": 1}):
        got = urlfilter.judge(df, entries=entries, **options)
        assert sorted(got.columns) == sorted(df.columns) and Counter(map(tuple, got.select(pick).collect())) == want
        assert urlfilter.judge(df.limit(0), entries=entries, **options).count() == 0
    assert urlfilter.judge(df, entries=entries.limit(0)).filter("verdict = 'block'").count() == 0


def test_url_list_of_thousands_hits_under_any_domain(spark):
    hosts = [f"m.{label}.example{k}.{top}" for label in urlfilter.JUNK for k in range(300) for top in ("com", "net", "xyz")]
    clean = ["http://example.com/a", "http://m.xadult-x.example.com/a", "http://spam-farm/a", "http://x.spam-farm/a"]
    rows = frame(spark, list(enumerate([*(f"http://{h}/a/{k}" for k, h in enumerate(hosts)), *clean])), "page_id long, url string")
    entries = urlfilter.junk_entries(rows)
    assert entries.count() == len(hosts)
    names = urlfilter.digest_files(entries, part_bytes=40_000)
    array = urlfilter.digest_array(tuple(map(SparkFiles.get, names)))
    assert len(names) > 3 and sum(len(keys) for keys, *_ in array.parts) == len(hosts)
    assert array.find([b"^adult-x.example7.net\n", b"=adult-x.example7.net\n", b"^nothing\n"]) == [3, -1, -1]
    assert {r["page_id"]: r["verdict"] for r in urlfilter.judge(rows, entries=entries).collect()} == {i: "block" if i < len(hosts) else "allow" for i in range(len(hosts) + len(clean))}


def test_url_pages_decide_alone_and_collisions_do_not(spark, monkeypatch):
    many = [(f"h{k}.org", f"/p/{k}", "list", "block", True) for k in range(3_000)]
    entries = spark.createDataFrame([*many, ("h1.org", "/p/1", "rule", "allow", False), ("a.net", "", "list", "block", False), ("a.net", "/x", "list", "allow", True)], "host string, path string, origin string, verdict string, whole boolean")
    urls = {"http://h7.org/p/7": "block", "http://h7.org/p/7?q#t": "block", "http://h7.org/p/77": "allow", "http://www.h7.org/p/7": "allow", "http://h1.org/p/1": "allow", "http://a.net/x": "allow", "http://a.net/xy": "block", "http://h2999.org/p/2999": "block", "x": "allow"}
    rows = spark.createDataFrame(list(urls.items()), "url string, want string")
    for options in ({}, {"most_bytes": 1}):
        assert urlfilter.judge(rows, entries=entries, **options).filter("verdict <> want").count() == 0
    # keys that collide: only the stored strings decide
    array = urlfilter.DigestArray(())
    blob = [b"^a.org\n", b"^b.org\n", b"^c.org\n"]
    ends = np.cumsum([0, *map(len, blob)]).astype(np.uint64)
    array.parts = [(np.array([5, 5, 9], np.uint64), ends, np.array([3, 0, 2], np.uint64), np.frombuffer(b"".join(blob), np.uint8))]
    monkeypatch.setattr(urlfilter.xxhash, "xxh64_intdigest", lambda b: 9 if b == b"^c.org\n" else 5)
    assert array.find([b"^b.org\n", b"^a.org\n", b"^x.org\n", b"^c.org\n"]) == [0, 3, -1, 2]


def test_url_join_takes_every_path_length(spark):
    entry = "repeat('x', cast(id as int))"
    entries = spark.range(1, 8200).selectExpr("'a.org' as host", f"'/' || {entry} as path", "'rule' as origin", "'block' as verdict", "false as whole")
    rows = spark.range(1, 13).selectExpr("id as page_id", "'http://a.org/' || repeat('x', cast(683 * id as int)) as url")
    got = {r[0]: r[1] for r in urlfilter.judge(rows, entries=entries, most_bytes=1).selectExpr("page_id", "length(rule)").collect()}
    assert got == {i: len("a.org/") + 683 * i for i in range(1, 13)}


# -- 7 ---------------------------------------------------------------------------------------------------------------
def test_packing(spark, awkward, empty):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = awkward[0] + [(50 + k, words(30 + 17 * k, 70 + k) + " Don't<|endoftext|>ǅ İ") for k in range(40)]
    got = packing.pack_documents(frame(spark, rows), max_tokens=512).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            want[(i, k, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert {r["moves"] for r in got if r["length"] < 512} != {0}
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 512
    assert len(bins) <= -(-sum(r["length"] for r in got) // 512) + 1
    assert packing.pack_documents(empty).count() == 0


def test_local_search_improves_and_loses_nothing():
    rng = np.random.default_rng(3)
    better = 0
    for n, lo, hi in ((60, 20, 60), (200, 30, 45), (40, 51, 99), (300, 1, 99)):
        for _ in range(10):
            lengths = rng.integers(lo, hi, n)
            before = [list(b) for b in packing.best_fit(lengths, 100)]
            after, _ = packing.improve([list(b) for b in before], lengths, 100)
            assert sorted(i for b in after for i in b) == list(range(n)) and all(sum(lengths[i] for i in b) <= 100 for b in after)
            assert -(-int(lengths.sum()) // 100) <= len(after) <= len(before)
            better += len(after) < len(before)
    assert better


def test_local_search_saves_hundreds_of_bins():
    e, n = 20, 500
    half, quarter = 2048, 1024
    lengths = np.repeat([half + e, quarter + 2 * e, quarter + e, quarter - 2 * e], [6 * n, 6 * n, 6 * n, 12 * n])
    before = packing.best_fit(lengths, 4096)
    after, steps = packing.improve([list(b) for b in before], lengths, 4096)
    assert steps > 200
    assert sorted(i for b in after for i in b) == list(range(len(lengths))) and all(lengths[b].sum() <= 4096 for b in after)
    assert len(before) == 11 * n and len(before) - len(after) > 200


def test_search_from_arrival_order_comes_near_the_bound():
    lengths = np.clip(np.random.default_rng(4).lognormal(6, 1, 4000).astype(int), 1, 4095)
    start = packing.best_fit(lengths, 4096, np.arange(len(lengths)))
    after, steps = packing.searched(lengths, 4096)
    need = -(-int(lengths.sum()) // 4096)
    assert sorted(i for b in after for i in b) == list(range(len(lengths))) and all(lengths[b].sum() <= 4096 for b in after)
    assert steps > 100 and len(after) < len(start) and len(after) <= need + 3
    assert packing.searched(lengths[:0], 4096) == ([], 0)


def test_packing_keeps_columns_of_any_name(spark):
    rows = spark.range(300).selectExpr("id % 7 as doc_id", "0 as piece", "100L as length", "id as pack_group", "id as row", "'x' as moves")
    got = packing.pack(packing.checkpointed(rows)).collect()
    assert sorted((r["pack_group"], r["row"]) for r in got) == [(k, k) for k in range(300)] and len({r["sequence_id"] for r in got}) == 8


def test_packing_deals_rows_of_one_key_to_many_groups(spark):
    rows = spark.range(0, 2000, 1, 4).selectExpr("cast(null as long) as doc_id", "0 as piece", "10L as length")
    got = packing.pack(packing.checkpointed(rows), 4096, group_rows=100).collect()
    groups = Counter(r["sequence_id"] >> 32 for r in got)
    assert len(got) == 2000 and len(groups) == 20 and max(groups.values()) < 200


# -- 8 ---------------------------------------------------------------------------------------------------------------
def test_toxicity_on_held_out_rows(spark, empty):
    rng = random.Random(9)
    plain, insults = [f"word{k}" for k in range(300)], ["idiotic", "moronic", "loweifoo", "loweibar"]
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 4 == 0
        t = rng.choices(plain, k=60) + (rng.choices(insults, k=rng.randint(1, 6)) if toxic else [])
        rng.shuffle(t)
        rows.append((i, " ".join(t) + "."))
        if i < 800:
            labels.append((i, 1, int(toxic)))
    rows += [(None, "idiotic moronic loweibaz"), (5000, None), (5001, "")]
    docs = frame(spark, rows, "doc_id long, text string, toxic string, severity string")
    model = toxicity.fitted(docs, frame(spark, labels, "doc_id long, quality int, toxic int"))
    assert model.thresholds == sorted(model.thresholds)
    got = {r["doc_id"]: r for r in toxicity.judged(docs, model).collect()}
    held = [i for i in range(800, 1200)]
    assert sum(got[i]["toxic"] != (i % 4 == 0) for i in held) <= 4
    assert got[None]["toxic"] and not got[5000]["toxic"] and not got[5001]["toxic"]
    assert all(0 <= r["severity"] <= 3 and r["grade"] in range(4) for r in got.values())
    none = toxicity.fitted(docs, frame(spark, [], "doc_id long, quality int, toxic int"))
    assert toxicity.judged(docs, none).filter("toxic").count() == 0 and toxicity.judged(empty, model).count() == 0


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(2)
    grade = rng.integers(0, 4, 400)
    x = rng.random((400, 6)) < 0.15 + 0.2 * grade[:, None]
    w, t = toxicity.fit_ordinal(toxicity.Sparse(*np.nonzero(x), *x.shape), grade, 4)
    mean = [(x[grade == g] @ w).mean() for g in range(4)]
    assert mean == sorted(mean) and list(t) == sorted(t) and (w > 0).all()


def test_grades_come_from_the_other_fold():
    rng = np.random.default_rng(4)
    strength = rng.random(600)
    toxic = strength > 0.5
    dense = rng.random((600, 8)) < 0.05 + 0.6 * (strength[:, None] - 0.3).clip(0)
    second = rng.random(600) < 0.5
    sparse = lambda m: toxicity.Sparse(*np.nonzero(m), *m.shape)
    grade = toxicity.fold_grades(sparse(dense), toxic, second)
    for fold in (second, ~second):
        w, _ = toxicity.fit_ordinal(sparse(dense[~fold]), toxic[~fold].astype(int), 2)
        eta = sorted(e for e, f, t in zip(dense @ w, fold, toxic) if f and t)
        low, high = np.quantile(eta, [1 / 3, 2 / 3])
        for i in np.flatnonzero(fold):
            assert grade[i] == (1 + sum(dense[i] @ w > c + 1e-12 for c in (low, high)) if toxic[i] else 0)
    mean = [strength[grade == g].mean() for g in range(4)]
    assert mean == sorted(mean)  # the grades follow a strength that no label tells
    one_sided = toxicity.fold_grades(sparse(dense), toxic, toxic)
    assert set(one_sided[toxic]) == {2} and not one_sided[~toxic].any()


def test_ordinal_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(7)
    x, grade = rng.random((30, 5)) < 0.4, rng.integers(0, 4, 30)
    sparse, weight, ridge = toxicity.Sparse(*np.nonzero(x), 30, 5), rng.random(30), 0.01
    sigmoid = lambda z: 1 / (1 + math.exp(-z))

    def loss(p):
        t = [p[5], p[5] + math.log1p(math.exp(p[6])), p[5] + math.log1p(math.exp(p[6])) + math.log1p(math.exp(p[7]))]
        out = ridge / 2 * sum(w * w for w in p[:5])
        for i in range(30):
            eta = sum(p[j] for j in range(5) if x[i, j])
            for j in range(3):
                q = sigmoid(eta - t[j])
                out -= weight[i] * math.log(q if grade[i] > j else 1 - q)
        return out

    p = rng.normal(size=8)
    got = toxicity.gradient(p, sparse, grade[:, None] > np.arange(3), weight, ridge)
    for j in range(8):
        step = np.zeros(8)
        step[j] = 1e-5
        assert got[j] == pytest.approx((loss(p + step) - loss(p - step)) / 2e-5, abs=1e-5)


def test_toxicity_lexicon_and_severity_against_loops(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(40)], k=20) + (["badword"] * rng.randint(1, 2) + ["Worse!"] if i % 3 == 0 else []))) for i in range(400)]
    rows += [(399, "other text"), (7, None)]
    docs, labels = frame(spark, rows), frame(spark, [(i, 1, int(i % 3 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    found = toxicity.sample(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), labels, 2_000)
    fit_half = {r["key"] for r in found.filter(toxicity.FIT_HALF).select("key").distinct().collect()}
    texts = {}
    for i, t in rows:
        texts[i] = min(texts.get(i, t or ""), t or "")
    sets = {i: toxicity.Features().of(t) for i, t in texts.items()}
    seen = defaultdict(set)
    for r in found.collect():
        seen[r["key"]] |= {r["feature"]} - {None}
    assert seen == sets
    size = [len([i for i in fit_half if (i % 3 == 0) == g]) for g in (False, True)]
    want = set()
    for f in set().union(*(sets[i] for i in fit_half)):
        n = [sum(f in sets[i] for i in fit_half if (i % 3 == 0) == g) for g in (False, True)]
        expected = [sum(n) * s / sum(size) for s in size]
        gain = 2 * sum(a * math.log(a / b) for a, b in zip(n, expected) if a)
        if n[1] >= 4 and gain > 18 and n[1] * size[0] > 5 * n[0] * size[1]:
            want.add(f)
    assert {r["feature"] for r in toxicity.telling(found, size).collect()} == want and want
    model = toxicity.fitted(docs, labels)
    assert set(model.weights) == want
    for r in toxicity.judged(docs, model).collect():
        eta = sum(w for f, w in model.weights.items() if f in toxicity.Features().of(r["text"] or ""))
        assert r["severity"] == pytest.approx(sum(1 / (1 + math.exp(t - eta)) for t in model.thresholds), abs=1e-9)
        assert r["toxic"] == (r["severity"] >= model.cut)


def test_toxicity_sample_is_bounded_and_takes_every_telling_feature(spark):
    bad = [f"curse{k}x{k}" for k in range(1200)]
    rows = [(i, " ".join(bad) if i % 2 else f"plain text {i}") for i in range(60)] + [(1, " ".join(bad))] * 500
    labels = frame(spark, [(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    model = toxicity.fitted(frame(spark, rows), labels, sample_rows=30)
    assert len(model.weights) > 1000
    assert toxicity.sample(frame(spark, rows).select("doc_id", "text"), labels, 30).select("key").distinct().count() == 60


# -- 9 ---------------------------------------------------------------------------------------------------------------
def brute_cover(template, text):
    a, b = ([re.sub(r"^\W+|\W+$", "", w.lower()) for w in SPACES.findall(x)] for x in (template, text))
    best = 0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
        best = row[-1]
    return best / len(a)


def test_license_scan(spark, empty):
    apache = licenses.TEMPLATES[3][2]
    cut = apache.split()
    changed = " ".join(cut[:20] + ["really"] + cut[20:30] + cut[32:])
    rows = [(1, "x " * 50 + "released UNDER the (MIT) License!\n" + words(30, 1)), (2, f"a b {changed} c d"), (3, " ".join(cut[:30])), (4, None), (5, ""), (6, words(300, 2)), (7, f"{apache} mid {apache}"), (None, "Licensed under CC BY-NC 4.0."), (8, "under the license the mit released")]
    got = licenses.scan(frame(spark, rows)).collect()
    found = Counter((r["doc_id"], r["license"], r["template"]) for r in got)
    assert found == Counter({(1, "MIT", "line"): 1, (2, "Apache-2.0", "header"): 1, (3, "Apache-2.0", "line"): 1, (7, "Apache-2.0", "header"): 2, (None, "CC-BY-NC-4.0", "line"): 1})
    texts = dict(rows)
    for r in got:
        span = texts[r["doc_id"]][r["start"] : r["end"]]
        template = next(t for n, k, t in licenses.TEMPLATES if (n, k) == (r["license"], r["template"]))
        assert r["coverage"] == pytest.approx(brute_cover(template, span))
    assert licenses.scan(empty).count() == 0


def test_adjacent_notices_give_as_many_matches():
    index, names = licenses.Index(licenses.TEMPLATES, 3, 2, 0.8, 15), licenses.TEMPLATES
    for t, (license_, kind, text) in enumerate(licenses.NOTICES):
        for n in (1, 2, 3, 5, 50):
            got = licenses.matches(" ".join([text] * n), index, names, 8)
            assert [(g[0], g[1], g[2]) for g in got] == [(license_, kind, len(index.words[t]))] * n
    line = names[0][2]
    for n in (2, 50):  # each lacks a word
        assert len(licenses.matches("\n".join(["Released under an MIT License."] * n), index, names, 8)) == n
    began = time.process_time()
    assert len(licenses.matches(f"{line} " * 20_000, index, names, 8)) == 20_000
    assert time.process_time() - began < 60
    rng = random.Random(3)
    for _ in range(10):
        put = [rng.choice([None, *range(len(licenses.NOTICES))]) for _ in range(30)]
        text = "\n".join(words(rng.randint(3, 12), k) if p is None else names[p][2] for k, p in enumerate(put))
        got = [(g[0], g[1]) for g in licenses.matches(text, index, names, 8)]
        assert got == [names[p][:2] for p in put if p is not None]


def test_license_candidates_miss_no_variant():
    index = licenses.Index(licenses.TEMPLATES, 3, 2, 0.8, 15)
    rng, texts = random.Random(7), ["Released under an MIT License.", "All rights reserved.", "released x under y the z mit w license"]
    for _, kind, text in licenses.TEMPLATES:
        cut = text.split()
        for _ in range(6 if kind != "body" else 1):
            lost = set(rng.sample(range(len(cut)), len(cut) // 5))
            texts.append(words(9, 1) + " " + " ".join(w if p not in lost else rng.choice(["", "qq"]) for p, w in enumerate(cut)) + " " + words(9, 2))
    checked = set()
    for text in texts:
        h = licenses.word_hashes(text)
        got = {t for *_, t in licenses.candidates(h, index, 8)}
        for t, w in enumerate(index.words):
            # brute force: the band around the place where the template would begin if nothing were lost before it
            places = [licenses.aligned(w, h, d - 8, d + 8) for d in range(-8, min(len(h), 60), 4)] if len(w) <= 700 else []
            best = min(places, key=licenses.tightest, default=(0, 0, 0))
            if best[0] >= 0.8 * len(w) and index.decided(t, h[best[1] : best[2]]):
                checked.add(t)
                # a line's words may lie scattered in its license's longer notice
                assert licenses.TEMPLATES[t][0] in {licenses.TEMPLATES[x][0] for x in got}, (licenses.TEMPLATES[t][:2], text)
    assert checked >= {t for t, (_, kind, _) in enumerate(licenses.TEMPLATES) if kind != "body"}


LINES = {
    "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
    "Released under the BSD License.": "BSD",
    "Released under the Apache License.": "Apache",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "Licensed under the MIT License, Version 2.0.": "MIT",
    "Licensed under the Mozilla Public License, Version 2.0.": "MPL-2.0",
    "Released under an MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the Foo License.": None,
    "This work is licensed under the GNU General Public License, version 4.": None,
    "This work is licensed under the Foo General Public License, version 3.": None,
}


@pytest.mark.parametrize("before, after", [("", ""), ("Words before it. ", " And words after it."), ("GNU tools: apache, mit and bsd. ", " More.")])
def test_no_wrong_license(before, after):
    index = licenses.Index(licenses.TEMPLATES, 3, 2, 0.8, 15)
    for line, license_ in LINES.items():
        got = [m[0] for m in licenses.matches(before + line + after, index, licenses.TEMPLATES, 8)]
        assert got == ([license_] if license_ else []), line


def test_no_template_matches_another_license():
    index = licenses.Index(licenses.TEMPLATES, 3, 2, 0.8, 15)
    for license_, kind, text in licenses.TEMPLATES:
        got = licenses.matches(f"a b c {text} d e f", index, licenses.TEMPLATES, 8)
        whole = max(got, key=lambda m: m[2])
        assert whole[:2] == (license_, kind) and whole[3] == 1
        if kind != "body":
            assert len(got) == 1, (license_, kind, got)
    gpl = next(t for n, k, t in licenses.TEMPLATES if (n, k) == ("GPL-3.0", "body"))
    other = gpl.replace("GNU General Public License", "GNU Affero General Public License").replace("GNU GENERAL", "GNU AFFERO GENERAL")
    assert "GPL-3.0" not in [m[0] for m in licenses.matches(other, index, licenses.TEMPLATES, 8) if m[1] == "body"]


def test_wide_alignment_equals_the_row_by_row_one():
    rng = np.random.default_rng(5)
    cases = [(rng.integers(0, 9, 30).astype(np.uint64), rng.integers(0, 9, n).astype(np.uint64), low) for n in (0, 5, 40, 90) for low in (-70, -20, 0, 15)]
    wide = [licenses.aligned_wide(a, b, low, low + 80) for a, b, low in cases]
    for (a, b, low), got in zip(cases, wide):
        none, row = (0, 0, 0), [(0, 0, 0)] * 81
        for i, w in enumerate(a.tolist()):
            now, left = [], none
            for c in range(81):
                j, best = i + low + c, max(row[c + 1] if c < 80 else none, left)
                if 0 <= j < len(b) and int(b[j]) == w:
                    best = max(best, (row[c][0] + 1, row[c][1] if row[c][0] else j, -(j + 1)))
                now.append(left := best)
            row = now
        assert got == min(((m, start, -end) for m, start, end in row), key=licenses.tightest)


def test_license_bodies_and_reserved_rights(spark):
    body = {n: t for n, kind, t in licenses.TEMPLATES if kind == "body"}
    rows = [(1, "(c) 2020 x. All rights reserved. " + words(20, 1)), (2, "Released under an MIT License."), *((10 + k, words(30, k) + " " + t) for k, t in enumerate(body.values()))]
    got = Counter((r["doc_id"], r["license"], r["template"]) for r in licenses.scan(frame(spark, rows)).collect())
    assert got[1, "All-rights-reserved", "line"] == got[2, "MIT", "line"] == 1
    assert all(got[10 + k, n, "body"] == 1 for k, n in enumerate(body))


# -- 10 --------------------------------------------------------------------------------------------------------------
def test_chat_examples(spark):
    rng = random.Random(4)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<<SYS>>", "<</SYS>>", "<<ROLE", "<</ROLE>>", " ", "\n", "a", "é", ">>", "", "<", "$1"]
    rows = []
    for c in range(40):
        for k in range(rng.randint(1, 7)):
            rows.append((c, k, rng.choice(["user", "assistant", "assistant", "system", "tool>>x", "to\\", "\\>>", "a\\\\<", None]), rng.choice([None, "".join(rng.choices(bits, k=rng.randint(0, 9)))])))
    rows += [(None, 0, "assistant", "x"), (90, None, "user", "y"), (91, 0, "user", "r"), (91, 0, "user", "r"), (92, 1, "assistant", "z" * 100_000)]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string")
    made = chat.examples(df)
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    groups = defaultdict(list)
    for c, k, role, t in rows:
        groups[c].append((k is not None, k or 0, role or "", t or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        g = got[c]
        assert (g["n_turns"], g["loss_chars"]) == (len(turns), len(loss))
        assert g["turns_sha256"] == digest("".join(f"{r}\n{t}\n" for _, _, r, t in turns)) and g["loss_sha256"] == digest(loss)
    for e in made.filter("loss_start is not null").collect():
        assert e["text"][e["loss_start"] - 4 : e["loss_start"]] == "<s> " and e["text"][e["loss_end"] :] == " </s>"
    replies = Counter(c for c, _, r, _ in rows if r == "assistant")
    assert Counter(e["conv_id"] for e in made.filter("loss_start is not null").collect()) == replies
    assert chat.digests(chat.examples(df.limit(0))).count() == 0


def test_chat_of_a_long_conversation(spark):
    """Three hundred turns, some long: every reply once, in order, all turns read back."""
    rows = [(5, k, "user" if k % 2 == 0 else "assistant", f"turn {k} </s> \\" + "x" * (k % 40 * 50)) for k in range(300)]
    got = chat.digests(chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    said = "".join(t for _, _, r, t in rows if r == "assistant")
    turns = "".join(f"{r}\n{t}\n" for _, _, r, t in rows)
    assert (got["n_turns"], got["loss_chars"]) == (300, len(said))
    assert (got["loss_sha256"], got["turns_sha256"]) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (said, turns))


def test_toxicity_of_a_very_long_text(spark):
    """A text of two million words is judged by all of them: one toxic part at its end counts."""
    bad, good = "vile nasty awful ", "calm plain words "
    docs = [(k, (bad if k % 2 else good) * 5, None) for k in range(60)] + [(100, good * 600_000 + bad * 5, None), (101, good * 600_000, None)]
    labels = [(k, 0, k % 2) for k in range(60)]
    frames = frame(spark, docs), frame(spark, labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["toxic"] for r in toxicity.judged(frames[0], toxicity.fitted(*frames)).collect()}
    assert got[100] and not got[101] and all(got[k] == bool(k % 2) for k in range(60))
