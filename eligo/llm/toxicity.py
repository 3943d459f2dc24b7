"""Toxicity as severity grades by cumulative-link (proportional odds) ordinal regression.

Grades 0 (clean) to 3 follow P(grade > j) = sigmoid(w x - t_j): one weight vector for all thresholds t_0 < t_1 < t_2.
x holds which sparse features a text has: its words and their first four and five letters, hashed. A document's
severity is its expected grade, the sum of P(grade > j); it is toxic where that reaches a cut.

The model is fitted on a bounded sample: ``sample_rows`` toxic labelled rows and four times as many clean ones, those
with the least hash of their key. Half of the sample fits the weights, the other half the cut: the one that loses
least, a clean row flagged counting as ``clean_weight`` missed toxic ones; where several do, the middle between them.
Features enter if the fitting half shows by a likelihood ratio test that toxic rows have them more often; all that do
enter. They are counted in Spark, and only they, with the sampled rows that hold them, reach the driver, as a sparse
matrix: its size follows the sample, not the texts' length.

Labels only say toxic or not. Toxic rows of the fitting half are graded 1 to 3 by thirds of what a plain logistic fit
on the other fold says of them, so a row's grade comes from other rows than itself (:func:`fold_grades`); which features
there are was found on both folds. No label says that the thirds are right: severity orders documents by how surely
other labelled rows call such text toxic; it is no measured harm.

Whole texts are scored, each in one pass in its task; a very long text's features are held in its task only.

Defined results: null and empty texts have no features and the lowest severity; with fewer than ``least_rows``
labelled rows, or those of one class only, nothing is toxic and severity is 0; where a fold lacks a class, toxic rows are all
of the middle grade; repeated rows are judged alike; rows
with a null key are judged like any other; extra columns are kept, with ``severity``, ``grade`` and ``toxic``
replaced; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from eligo.llm.common import blocks, checkpointed, table, text_of

BUCKETS = 1 << 22
EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~¡¿«»…—–“”‘’"
CACHE_WORDS = 400_000


def word_features(word: str) -> tuple[int, ...]:
    """Buckets of a lower-case word and of its first four and five letters."""
    word = word.strip(EDGE)
    if not word:
        return ()
    names = [word] + [f"{word[:n]}~" for n in (4, 5) if len(word) >= n]
    return tuple(xxhash.xxh32_intdigest(x) % BUCKETS for x in names)


class Features(dict):
    """Wanted features of words; a bounded memory."""

    def __init__(self, wanted: set[int] | None = None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = word_features(word)
        if self.wanted is not None:
            got = tuple(f for f in got if f in self.wanted)
        self[word] = got
        return got

    def of(self, text: str) -> set[int]:
        return set().union(*map(self.__getitem__, set(text.lower().split())))


@dataclass
class Model:
    weights: dict[int, float]
    thresholds: list[float]
    cut: float

    def severity(self, eta: np.ndarray) -> np.ndarray:
        return sum((1 / (1 + np.exp(t - eta)) for t in self.thresholds), np.zeros(len(eta)))


@dataclass
class Sparse:
    """Zeros and ones: (row[i], column[i]) are the ones."""

    row: np.ndarray
    column: np.ndarray
    rows: int
    columns: int

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.rows)

    def back(self, v: np.ndarray) -> np.ndarray:
        """The transposed matrix times ``v``."""
        return np.bincount(self.column, v[self.row], self.columns)

    def of_rows(self, keep: np.ndarray) -> Sparse:
        ones = keep[self.row]
        return Sparse((np.cumsum(keep) - 1)[self.row[ones]], self.column[ones], int(keep.sum()), self.columns)


def gradient(params: np.ndarray, x: Sparse, above: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Of the weighted negative log-likelihood with a ridge on the weights. ``params``: weights, the first threshold,
    and what gives the steps between thresholds by softplus."""
    k = x.columns
    t = params[k] + np.concatenate([[0.0], np.cumsum(np.log1p(np.exp(params[k + 1 :])))])
    p = 1 / (1 + np.exp(np.clip(t - x.times(params[:k])[:, None], -30, 30)))
    err = weight[:, None] * (p - above)
    by_t = -err.sum(0)
    steps = np.cumsum(by_t[::-1])[::-1][1:] / (1 + np.exp(-params[k + 1 :]))
    return np.concatenate([x.back(err.sum(1)) + ridge * params[:k], [by_t.sum()], steps])


def fit_ordinal(x: Sparse, grade: np.ndarray, grades: int, rounds: int = 400, ridge: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of a proportional odds model, by accelerated gradient steps. Grades weigh alike."""
    k = x.columns
    above = grade[:, None] > np.arange(grades - 1)
    weight = (1 / np.maximum(1, np.bincount(grade, minlength=grades)))[grade]
    weight = weight / weight.sum()
    params = np.concatenate([np.zeros(k), [0.0], np.ones(grades - 2)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        grad = gradient(params, x, above, weight, ridge)
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        params = params - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    gaps = np.log1p(np.exp(params[k + 1 :]))
    return params[:k], params[k] + np.concatenate([[0.0], np.cumsum(gaps)])


def fold_grades(x: Sparse, toxic: np.ndarray, second: np.ndarray) -> np.ndarray:
    """0 for clean rows; 1 to 3 for toxic ones, by thirds within their fold of what a fit on the other fold gives them.

    ``second``: the rows of the second fold. Where a fold lacks a class, toxic rows are graded 2."""
    grade = np.where(toxic, 2, 0)
    if any(not (toxic & f).any() or not (~toxic & f).any() for f in (second, ~second)):
        return grade
    for fold in (second, ~second):
        weights, _ = fit_ordinal(x.of_rows(~fold), toxic[~fold].astype(int), 2)
        eta, mine = x.times(weights), fold & toxic
        low, high = np.quantile(eta[mine], [1 / 3, 2 / 3])
        grade[mine] = 1 + (eta[mine] > low) + (eta[mine] > high)
    return grade


def best_cut(severity: np.ndarray, toxic: np.ndarray, clean_weight: float) -> float:
    """The cut of least loss: missed toxic share plus ``clean_weight`` times the flagged clean share."""
    places = np.unique(severity)
    cuts = np.concatenate([[places[0] - 1], (places[1:] + places[:-1]) / 2, [places[-1] + 1]])
    bad, good = np.sort(severity[toxic]), np.sort(severity[~toxic])
    missed = np.searchsorted(bad, cuts) / len(bad)
    flagged = 1 - np.searchsorted(good, cuts) / len(good)
    loss = missed + clean_weight * flagged
    best = np.flatnonzero(loss <= loss.min() + 1e-12)
    return float((cuts[best[0]] + cuts[best[-1]]) / 2)


def sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """key, toxic and feature of every sampled row of ``docs`` (doc_id, text): a row for each feature, checkpointed.
    Of rows that share a key the one with the least text is taken."""
    named = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max("toxic").alias("toxic"))
    parts = [named.filter(F.col("toxic") == g).orderBy(F.xxhash64("key", F.lit(3)), "key").limit(n) for g, n in ((0, 4 * sample_rows), (1, sample_rows))]
    keys = F.broadcast(parts[0].unionAll(parts[1]))

    @arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        memory = Features()
        sets = [np.fromiter(memory.of(t), np.int32) for t in texts.to_pylist()]
        flat = np.concatenate(sets) if sets else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(flat, pa.int32()))

    rows = docs.join(keys, docs["doc_id"] == keys["key"]).groupBy("key", "toxic").agg(F.min("text").alias("text"))
    return checkpointed(rows.select("key", "toxic", F.explode_outer(run("text")).alias("feature")))


#: The fitting half of the sample, and its second fold, as conditions on its rows.
FIT_HALF = "pmod(xxhash64(key, 5), 2) = 0"
SECOND_FOLD = "pmod(xxhash64(key, 13), 2) = 1"


def telling(rows: DataFrame, size: list[int]) -> DataFrame:
    """feature: those that toxic rows of the fitting half have more often, by a likelihood ratio test.

    ``size``: clean and toxic rows of that half."""
    count = lambda g: F.count(F.when(F.col("toxic") == g, 1)).cast("double")
    seen = rows.filter(FIT_HALF).filter("feature is not null").groupBy("feature").agg(count(0).alias("good"), count(1).alias("bad")).filter("bad >= 4")
    expected = [(F.col("good") + F.col("bad")) * (n / sum(size)) for n in size]
    part = lambda o, e: F.when(o > 0, o * F.log(F.greatest(o, F.lit(1.0)) / e)).otherwise(0.0)
    gain = 2 * (part(F.col("good"), expected[0]) + part(F.col("bad"), expected[1]))
    often = F.col("bad") * size[0] > 5 * F.col("good") * size[1]  # five times as often, whatever the classes' sizes
    return seen.filter((gain > 18) & often).select("feature")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 2_000, clean_weight: float = 10.0, least_rows: int = 20) -> Model:
    rows = sample(docs, labels, sample_rows)
    heads = rows.select("key", "toxic", F.expr(FIT_HALF).alias("fit"), F.expr(SECOND_FOLD).alias("second")).distinct().toArrow().sort_by("key")
    key, toxic = heads["key"].to_numpy(), heads["toxic"].to_numpy() == 1
    half, second = (np.asarray(heads[c].to_pylist(), bool) for c in ("fit", "second"))
    size = [int((half & (toxic == g)).sum()) for g in (False, True)]
    if not all(size) or len(toxic) < least_rows:
        return Model({}, [], 1.0)
    hits = rows.join(telling(rows, size), "feature").select("key", "feature").toArrow().sort_by([("key", "ascending"), ("feature", "ascending")])
    if not hits.num_rows:
        return Model({}, [], 1.0)
    features, column = np.unique(hits["feature"].to_numpy(), return_inverse=True)
    x = Sparse(np.searchsorted(key, hits["key"].to_numpy()), column, len(toxic), len(features))
    fitting = x.of_rows(half)
    weights, thresholds = fit_ordinal(fitting, fold_grades(fitting, toxic[half], second[half]), 4)
    model = Model(dict(zip(features.tolist(), weights.tolist())), thresholds.tolist(), 0.5)
    rest = ~half
    if toxic[rest].any() and not toxic[rest].all():
        model.cut = best_cut(model.severity(x.of_rows(rest).times(weights)), toxic[rest], clean_weight)
    return model


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with severity, grade (the nearest whole grade) and toxic."""

    @arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        memory, weights = Features(set(model.weights)), model.weights
        eta = []
        for at, to in blocks(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)):
            eta += [sum(weights[f] for f in sorted(memory.of(t or ""))) for t in texts.slice(at, to - at).to_pylist()]
        return pa.array(model.severity(np.asarray(eta, float)), pa.float64())

    kept = [c for c in docs.columns if c not in ("severity", "grade", "toxic")]
    scored = docs.select(*kept, run(text_of(docs)).alias("severity"))
    return scored.select("*", F.round("severity").cast("int").alias("grade"), (F.col("severity") >= model.cut).alias("toxic"))


def fitted(docs: DataFrame, labels: DataFrame, **options) -> Model:
    return fit(docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")), labels, **options)


def op8_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    return judged(docs.select("doc_id", "text"), model).select("doc_id", "severity", "grade", "toxic", (~F.col("toxic")).alias("kept"))
