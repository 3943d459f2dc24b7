"""Quality rules by a hashed n-gram log-likelihood ratio, with DataFrame functions only.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials over the buckets are counted: the
raw corpus over all rows, and trusted target text over half of all well-labelled rows. A document's score is
the mean over its n-grams of log p_target - log p_raw, so long texts weigh no more than short ones. The threshold is
fixed from the other half of all labelled rows, which the target has not seen: the cut that loses least, a lost good row counting as
``good_weight`` accepted bad ones. Documents that fail the base rules (too short, or too repetitive) are rejected
whatever their score.

Nothing but the two count vectors (``buckets`` numbers each), a histogram of scores (``bins`` numbers) and up to
:data:`BROADCAST_KEYS` labelled keys reaches the driver; more labels are joined by a shuffle.

Defined results: null and empty texts have no words and fail the base rules; documents without n-grams score 0; with
no usable labels every document that passes the base rules is kept; repeated rows are judged alike; extra columns are
ignored by the query; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import SPACE, table, text_of

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _pairs(hashes: str, step: int) -> Column:
    """Hash of each element with the one ``step`` places on; the last ``step`` have none to pair with."""
    xs = F.col(hashes)
    return F.zip_with(xs, F.slice(xs, step + 1, F.size(xs)), lambda a, b: F.xxhash64(a, b))


def _head(name: str, drop: int) -> Column:
    return F.slice(F.col(name), 1, F.greatest(F.size("h1") - drop, F.lit(0)))


def hashed(docs: DataFrame, extra: list[str] = []) -> DataFrame:
    """h1: hashes of the words; h2: of each word with the next (the last has none)."""
    h1 = docs.select(*extra, F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("h1"))
    return h1.select("*", _pairs("h1", 1).alias("h2"))


def ngrams(buckets: int) -> Column:
    return F.transform(F.concat(F.col("h1"), _head("h2", 1)), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def base_columns(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The base rules' figures, and h1, h2 for the score. ``docs`` has ``text`` without nulls."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    a = docs.select(*keep, words_of(text).alias("words"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), lines.alias("lines"))
    a = a.select(
        *keep,
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"),
    )
    a = a.select("*", _pairs("h1", 1).alias("h2"))
    a = a.select("*", _pairs("h2", 2).alias("h4"))
    a = a.select("*", _pairs("h4", 4).alias("h8")).drop("h4")
    a = a.withColumn("windows", _head("h8", WINDOW - 1)).drop("h8")
    # only texts in which a window occurs twice are sorted
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    a = a.withColumn("sorted", F.when(repeats, F.sort_array(placed))).drop("windows")
    same = lambda x, k: F.coalesce(F.try_element_at(F.col("sorted"), k)["h"] == x["h"], F.lit(False))
    twice = F.filter("sorted", lambda x, k: F.when(k > 0, same(x, k)).otherwise(False) | same(x, k + 2))
    a = a.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("sorted")
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    cover = F.aggregate("starts", zero, lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(i, acc["to"])).alias("n"), (i + WINDOW).alias("to")), lambda acc: acc["n"])
    a = a.withColumn("n_repeat_words", F.coalesce(cover, F.lit(0)).cast("long")).drop("starts")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return a.withColumn("base_failed", failed)


def labelled(labels: DataFrame) -> DataFrame:
    """key, good, fit: every labelled key once, parted into two halves by a hash."""
    named = labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max("quality").alias("good"))
    return named.withColumn("fit", F.pmod(F.xxhash64("key", F.lit(11)), F.lit(2)) == 0)


def sample_keys(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` of the :func:`labelled` keys of each label, those with the least hash, to look at; the fit takes all."""
    rank = F.xxhash64("key", F.lit(7))
    parts = [labelled(labels).filter(F.col("good") == g).orderBy(rank, "key").limit(rows) for g in (0, 1)]
    return parts[0].unionAll(parts[1])


def with_labels(docs: DataFrame, keys: DataFrame, how: str, few: bool) -> DataFrame:
    """``docs`` joined with ``keys``: broadcast if they are few; else rows move to their keys, and rows without a key,
    which meet none, are spread by their text."""
    if few:
        return docs.join(F.broadcast(keys), docs["doc_id"] == keys["key"], how)
    own = F.when(docs["doc_id"].isNull(), F.xxhash64(docs["text"])).otherwise(F.lit(0).cast("long"))
    return docs.join(keys.hint("merge"), (docs["doc_id"] == keys["key"]) & (own == keys["nought"]), how)


class Ratio:
    """A fitted log-likelihood ratio: ``weights`` per bucket and the threshold for the mean."""

    def __init__(self, weights: list[float], threshold: float):
        self.weights, self.threshold = weights, threshold

    def score(self, grams: Column) -> Column:
        table_ = F.split(F.lit(",".join(f"{w:.6f}" for w in self.weights)), ",").cast("array<double>")
        total = F.aggregate(grams, F.lit(0.0), lambda acc, b: acc + table_[b])
        return total / F.greatest(F.size("h1") * 2 - 1, F.lit(1))


#: Labelled keys up to which they are broadcast.
BROADCAST_KEYS = 1_000_000


def fit(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 14, broadcast_keys: int = BROADCAST_KEYS, bins: int = 2_000, good_weight: float = 20.0) -> Ratio:
    """``docs``: doc_id, text (no nulls). All labelled rows count, half of them in the target and half for the threshold."""
    keys = labelled(labels).withColumn("nought", F.lit(0).cast("long"))
    few = keys.limit(broadcast_keys + 1).count() <= broadcast_keys
    marked = with_labels(docs, keys, "left", few)
    target = (F.coalesce(F.col("good"), F.lit(0)) == 1) & F.coalesce("fit", F.lit(False))
    grams = hashed(marked.withColumn("target", target), ["target"]).select("target", F.explode(ngrams(buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum(F.col("target").cast("int")).alias("target")).collect()
    raw, good = [0.0] * buckets, [0.0] * buckets
    for r in counts:
        raw[r["bucket"]], good[r["bucket"]] = r["raw"], r["target"]
    n_raw, n_good = sum(raw), sum(good)
    if not n_good:
        return Ratio([0.0] * buckets, -math.inf)
    weights = [math.log((g + 0.5) / (n_good + 0.5 * buckets)) - math.log((r + 0.5) / (n_raw + 0.5 * buckets)) for g, r in zip(good, raw)]
    ratio = Ratio([float(f"{w:.6f}") for w in weights], -math.inf)
    held = with_labels(docs, keys.filter("not fit"), "inner", few)
    scored = hashed(held, ["good"]).filter(F.size("h1") >= 20).select("good", ratio.score(ngrams(buckets)).alias("score"))
    span = 20.0
    bin_ = F.floor((F.greatest(F.least("score", F.lit(span / 2)), F.lit(-span / 2)) + span / 2) * (bins / span))
    seen = scored.groupBy(bin_.alias("bin"), "good").count().collect()
    have = {(r["bin"], r["good"]): r["count"] for r in seen}
    n = [max(1, sum(v for (_, g), v in have.items() if g == k)) for k in (0, 1)]
    lost, passed = 0, sum(v for (_, g), v in have.items() if g == 0)
    best, cut, last = passed / n[0], None, None
    for b in range(bins + 1):  # the cut lies under bin b
        cost = good_weight * lost / n[1] + passed / n[0]
        if cost < best:
            best, cut, last = cost, b, b
        elif cut is not None and last == b - 1 and cost == best:
            last = b  # no labelled row in between: the middle of the gap is the cut
        lost += have.get((b, 1), 0)
        passed -= have.get((b, 0), 0)
    ratio.threshold = -math.inf if cut is None else (cut + last) / 2 * (span / bins) - span / 2
    return ratio


FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]


def judged(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 14, **options) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc``, with :data:`FIGURES`; no column of ``docs`` can clash."""
    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    ratio = fit(plain, labels, buckets, **options)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), text_of(docs).alias("text"))
    a = base_columns(rows, ["doc"]).withColumn("score", ratio.score(ngrams(buckets)))
    return a.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(ratio.threshold))).select("doc", *FIGURES)


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    The filter also reads a row number, which cannot be moved: without it the optimizer would push the filter below
    the chain of columns that it depends on and write each of them out anew wherever it is used."""
    rows = judged(docs, labels, **options).withColumn("at", F.monotonically_increasing_id())
    return rows.filter("kept and at >= 0").select("doc.*")


def op2_quality_rules(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, table(spark, sf_dir, "labels")).select("doc.doc_id", *FIGURES)
