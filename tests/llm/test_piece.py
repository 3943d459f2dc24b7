"""Piece BPE against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eligo.llm import piece
from eligo.llm.common import Remembered, tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
ALPHABETS = ["abcde ", "▁ a\n\t", "the andof", "éèа бвг", "日本語 x", "()[]{}*=-_ ", "'\",.;: ", " ", "a", "-", "=", "*😀‍<s></s>\0"]
EDGES = ["", " ", "  ", "<s>hi</s>", "<0x0A>", "▁", "a▁b", " " * 100 + "the", " " * 17 + "\n", " " * 16, " " * 33 + "a", "-" * 1000, "a" * 3000, "ab" * 1000, "=" * 77, "\0", "Ĳ⁇ ⁇"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids(coded):
    return [np.frombuffer(c, "<i4").tolist() for c in coded]


def decoded(coder, rows):
    return coder.decode(np.array([i for r in rows for i in r], np.int32), np.cumsum([0, *map(len, rows)]))


def cases():
    rng = random.Random(11)
    mixed = ["".join(rng.choice(a) for _ in range(rng.randint(0, 60))) for a in (rng.choice(ALPHABETS) + rng.choice(ALPHABETS) for _ in range(1500))]
    dense = ["".join(rng.choice("etaoinshrdlu") for _ in range(400)) for _ in range(60)]
    return EDGES + mixed + dense


def test_equals_the_library(library):
    coder, texts = piece.pieces(PATH), cases()
    want = [library.encode(t) for t in texts]
    got = ids(coder.encode(texts))
    assert got == want
    assert decoded(coder, got) == [library.decode(w) for w in want]
    assert ids(coder.encode(texts)) == want  # now remembered


def test_every_character(library):
    coder = piece.pieces(PATH)
    for t in ("".join(map(chr, range(1, 0xD800))), " ".join(map(chr, range(0xE000, 0x11000))), "".join(map(chr, range(0x1F000, 0x1FB00)))):
        got = ids(coder.encode([t]))
        assert got == [library.encode(t)] and decoded(coder, got) == [library.decode(got[0])]


def test_any_ids_decode(library):
    rng = random.Random(3)
    rows = [[rng.choice([rng.randrange(259, 32000), rng.randrange(3, 259), 0, 259, 29871]) for _ in range(rng.randint(0, 8))] for _ in range(2000)]
    assert decoded(piece.pieces(PATH), rows) == [library.decode(r) for r in rows]
    with pytest.raises(ValueError):
        decoded(piece.pieces(PATH), [[32000]])


def test_long_words(library):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30_000)), "ab" * 200_000, "日" * 100_000 + "a" * 100_000, " " * 30_000 + "end", "x" * 1_000_000, "the" * 20_000]
    coder = piece.pieces(PATH)
    before = coder.memory.held
    for t, g in zip(texts, ids(coder.encode(texts))):
        assert g == library.encode(t)
    assert coder.memory.held - before < 1 << 20


def test_restless_pairs_merge_one_at_a_time(library):
    """Words in which a merge makes a pair of better rank, next to others of the old rank."""
    coder = piece.pieces(PATH)
    order = {library.get_score(i): i for i in range(259, 32000)}
    ranks = sorted(order, reverse=True)
    restless = [library.id_to_piece(order[ranks[k]]) for k in range(2000) if coder.restless[k]]
    rng = random.Random(9)
    texts = ["".join(rng.choice(restless).strip("▁") for _ in range(rng.randint(2, 60))) for _ in range(800)]
    assert coder.restless.any() and ids(coder.encode(texts)) == [library.encode(t) for t in texts]


def test_memory_is_bounded_by_bytes():
    memory, asked = Remembered(most=2_000, longest=10), []

    def learn(words):
        asked.append(sorted(words))
        return [w.encode() for w in words]

    for words in ({"a", "b"}, {"b", "c", "x" * 50}, {f"w{k}" for k in range(7)}, {"a", "x" * 50}, {f"v{k}" for k in range(40)}, {"v1"}):
        get = memory.all(words, learn)
        assert all(get(w) == w.encode() for w in words) and memory.held <= 2_000 and "x" * 50 not in memory
    assert asked[:2] == [["a", "b"], ["c", "x" * 50]]


def test_rows(spark, library):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Straße 日本 😀"), (4, "Straße 日本 😀"), (None, "x " * 5_000), (5, "<s> </s> ▁")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("kept"))
    got = df.select("doc_id", "text", "ids", piece.encode(F.col("text")).alias("coded")).withColumn("decoded", piece.decode(F.col("coded"))).collect()
    assert [(r["coded"], r["decoded"]) for r in got] == [(library.encode(t or ""), library.decode(library.encode(t or ""))) for _, t in rows]
    assert [r["ids"] for r in got] == ["kept"] * len(rows)
    assert df.limit(0).select(piece.decode(piece.encode(F.col("text")))).count() == 0
    assert spark.sql("select cast(null as array<int>) as a").select(piece.decode(F.col("a")).alias("t")).first()["t"] is None


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in piece.op11_piece_rounds(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, t in rows:
        own = library.encode(t or "")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(got[i])[1:] == (len(own), digest(",".join(map(str, own))), digest(library.decode(own)))
