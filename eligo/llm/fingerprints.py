"""Homomorphic multiset fingerprints of documents, with DataFrame functions only.

A document is the multiset of its paragraphs (the pieces between newlines). Each paragraph has a wide vector, and a
fingerprint is the sum of its paragraphs' vectors, lane by lane, modulo 2^32:

* ``exact``: 16 lanes of 32 bits, expanded from the paragraph's SHA-256. Equal multisets have equal lanes in any order
  of paragraphs; different ones differ but for hash collisions.
* ``marks``: 128 lanes (two to a long). Each sentence of the paragraph adds the bits of its hashes. Around their mean
  they are sums of random signs, so the distance of two fingerprints estimates how many sentences differ.
  The last element counts the sentences.

:func:`inserted` and :func:`deleted` update a fingerprint by a paragraph without its text being read again.

Defined results: a null text is the empty text, whose fingerprint has one empty paragraph and no sentence; equal
rows have equal fingerprints; rows with a null key come last in the order of documents, ties go by text; one document
alone is its own next document; an empty table gives no rows; extra columns are ignored. The order is sorted block by
block: rows that share a key, or have none, are one block, which its task sorts with the help of the disk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eligo.llm.common import table, text_of

LANES, HALF = 16, 0xFFFFFFFF
#: Longs with two 32-bit marks each; one hash of a sentence fills 32 of them.
MARKS = 64
BOTH = (1 << 32) | 1


def _zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0).cast("long"), n)


def fingerprint(text: Column) -> Column:
    """struct<exact: array<long>, marks: array<long>> of a text; the last of the marks is the number of sentences."""
    digests = F.transform(F.split(text, "\n"), lambda p: F.sha2(p.cast("binary"), 256))
    exact = F.aggregate(digests, _zeros(LANES), lambda acc, d: F.transform(acc, lambda x, i: (x + F.xxhash64(d, i).bitwiseAND(HALF)).bitwiseAND(HALF)))
    sentences = F.filter(F.split(text, r"\n|(?<=[.!?]) "), lambda s: s != "")
    hashes = F.transform(sentences, lambda s: F.array(F.xxhash64(s), F.xxhash64(s, F.lit(1))))

    def add(x: Column, i: Column, h: Column) -> Column:
        # long i takes the bits i and i + 32 of the first hash, or of the second from the half on
        bits = F.call_function("shiftrightunsigned", F.when(i < 32, h[0]).otherwise(h[1]), i % 32).bitwiseAND(BOTH)
        return F.when(i == MARKS, x + 1).otherwise(x + bits)

    marks = F.aggregate(hashes, _zeros(MARKS + 1), lambda acc, h: F.transform(acc, lambda x, i: add(x, i, h)))
    return F.struct(exact.alias("exact"), marks.alias("marks"))


def _changed(f: Column, paragraph: Column, sign: int) -> Column:
    g = fingerprint(paragraph)
    put = lambda name: F.zip_with(f[name], g[name], lambda x, y: x + sign * y)
    return F.struct(F.transform(put("exact"), lambda x: x.bitwiseAND(HALF)).alias("exact"), put("marks").alias("marks"))


def inserted(f: Column, paragraph: Column) -> Column:
    """The fingerprint of a document that gains ``paragraph`` (a text without newlines) anywhere."""
    return _changed(f, paragraph, 1)


def deleted(f: Column, paragraph: Column) -> Column:
    """The fingerprint of a document that loses ``paragraph``."""
    return _changed(f, paragraph, -1)


def likeness(f: Column, g: Column) -> Column:
    """0 to 1: estimated share of common sentences, 2 common / (all of both); 1 for equal fingerprints."""
    signs = lambda m, units, high: 2.0 * (F.shiftright(m, 32) if high else m.bitwiseAND(HALF)) - units
    lanes = F.slice(F.zip_with(f["marks"], g["marks"], lambda a, b: F.struct(a.alias("a"), b.alias("b"))), 1, MARKS)
    n, m = f["marks"][MARKS], g["marks"][MARKS]
    zero = F.struct(F.lit(0.0).alias("apart"), F.lit(0.0).alias("whole"))

    def add(acc: Column, lane: Column) -> Column:
        xs, ys = [signs(lane["a"], n, h) for h in (False, True)], [signs(lane["b"], m, h) for h in (False, True)]
        apart = sum(((x - y) * (x - y) for x, y in zip(xs, ys)), acc["apart"])
        return F.struct(apart.alias("apart"), sum((v * v for v in xs + ys), acc["whole"]).alias("whole"))

    share = F.aggregate(lanes, zero, add, lambda acc: F.when(acc["whole"] == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - acc["apart"] / acc["whole"])))
    return F.when((f["exact"] == g["exact"]) & (f["marks"] == g["marks"]), F.lit(1.0)).otherwise(share)


def as_text(f: Column) -> Column:
    """Hexadecimal digits of all lanes."""
    wide = lambda xs, n: F.array_join(F.transform(xs, lambda x: F.lpad(F.hex(x), n, "0")), "")
    return F.concat(wide(f["exact"], 8), wide(f["marks"], 16))


def in_order(docs: DataFrame, block_rows: int = 512, most_blocks: int = 65_536):
    """``docs`` (doc_id, text) dealt into blocks, and the window over which ``lead`` gives the next row in descending
    doc_id; the last row's next is the first. Rows marked ``guest`` are there for that only.

    The ids' quantiles part the rows into blocks of about ``block_rows``; each block is sorted on its own, and the
    first row of the block below is also dealt to the block above it, so rows cross the network once."""
    rows = docs.filter("doc_id is not null").count()
    blocks = max(1, min(most_blocks, rows // block_rows))
    cuts = [k / blocks for k in range(1, blocks + 1)]
    at = docs.agg(F.percentile_approx("doc_id", cuts, 20 * blocks).alias("q")).first()["q"] or []
    bounds = sorted(set(at))
    n = max(1, len(bounds))
    known = F.split(F.lit(",".join(map(str, bounds)) or "0"), ",").cast("array<long>")
    # how many bounds lie under the id, by halving
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(n.bit_length()))))
    under = F.aggregate(steps, F.lit(0), lambda lo, s: F.when((lo + s <= n) & (F.try_element_at(known, lo + s) < F.col("doc_id")), lo + s).otherwise(lo))
    placed = docs.withColumn("block", F.when(F.col("doc_id").isNull(), 0).otherwise(F.least(under, F.lit(n - 1))))
    head = F.coalesce(F.try_element_at(known, F.col("block") + 1) == F.col("doc_id"), F.lit(False))
    here = F.struct(F.col("block"), F.lit(False).alias("guest"))
    above = F.struct(((F.col("block") + 1) % n).alias("block"), F.lit(True).alias("guest"))
    dealt = placed.withColumn("at", F.explode(F.when(head, F.array(here, above)).otherwise(F.array(here)))).select(*docs.columns, "at.block", "at.guest")
    return dealt.repartition("block"), Window.partitionBy("block").orderBy(F.col("guest"), F.col("doc_id").desc_nulls_last(), F.col("text"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last third is taken from the next document."""
    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    dealt, order = in_order(plain)
    dealt = dealt.withColumn("f", fingerprint(F.col("text")))
    following = F.struct("text", "f")
    nexts = dealt.withColumn("next", F.coalesce(F.lead(following).over(order), F.first(following).over(order))).filter("not guest")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - third), F.col("next.text").substr(F.lit(1), third))
    made = nexts.select("doc_id", n.cast("long").alias("n_chars"), "f", F.col("next.f").alias("g"), edited.alias("edited"))
    made = made.select("doc_id", "n_chars", "f", "g", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("e"))
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e")).alias("near_edited"),
        likeness(F.col("f"), F.col("g")).alias("near_next"),
    )


def op1_fingerprints(spark, sf_dir) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
