"""The pipeline and the registered corpus queries on the smallest tables."""

import math
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eligo.llm import quality, toxicity
from eligo.llm.common import tokenizer_path
from eligo.llm.queries import ORACLES, QUERIES
from test_llm import SPACES, base_rules, brute_groups, spark_hash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name != "packing":
            assert docs.columns == columns and 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before


def test_stages_against_brute_force(spark, tmp_path):
    """Each stage's decisions from loops over whole texts; only the fitted numbers are taken from the operators."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs, stages = spark.read.parquet(f"{SF}/documents.parquet"), dict(corpus_pipeline.STAGES)
    rows = lambda df: {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}

    def after(name):
        stages[name](spark, docs, SF).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    ratio, texts = quality.fit(docs.select("doc_id", "text"), labels), rows(docs)
    size, want = len(ratio.weights), set()
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    for i, t in texts.items():
        h = [spark_hash(w) for w in SPACES.findall(t)]
        grams = [signed(x) % size for x in h + [spark_hash(a, b) for a, b in zip(h, h[1:])]]
        if not base_rules(t)[-1] and sum(ratio.weights[b] for b in grams) / max(1, len(grams)) >= ratio.threshold:
            want.add(i)
    docs = after("quality rules")
    assert set(rows(docs)) == want

    model, texts = toxicity.fitted(docs, labels), rows(docs)
    severity = lambda eta: sum(1 / (1 + math.exp(t - eta)) for t in model.thresholds)
    want = {i for i, t in texts.items() if severity(sum(w for f, w in model.weights.items() if f in toxicity.Features().of(t))) < model.cut}
    docs = after("toxicity")
    assert set(rows(docs)) == want

    texts = rows(docs)
    want = {i for (i, _, _, kept), _ in brute_groups(list(texts.items()), 5, 80).items() if kept}
    docs = after("near-duplicates")
    assert set(rows(docs)) == want

    from tokenizers import Tokenizer

    lib, texts = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), rows(docs)
    want, bins = set(), {}
    for i, t in texts.items():
        n = len(lib.encode(t, add_special_tokens=False).ids) + 1
        want |= {(i, k, at, min(4096, n - at)) for k, at in enumerate(range(0, n, 4096))}
    got = after("packing").collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"]) for r in got} == want and len(got) == len(want)
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in b) <= 4096 and all(at == sum(n for _, n in sorted(b)[:k]) for k, (at, _) in enumerate(sorted(b))) for b in bins.values())
    assert len(bins) <= -(-sum(n for *_, n in want) // 4096) + 1


def test_empty_table_passes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_awkward_rows_pass_every_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = docs.filter("length(text) > 400 and lang = 'en'").limit(40).withColumn("component", F.lit("x")).withColumn("pack_group", F.lit(7))
    two = plain.limit(2)
    odd = two.withColumns({"doc_id": F.lit(None).cast("long"), "source": F.lit(None).cast("string")}).unionByName(plain.limit(3).withColumn("text", F.lit(None).cast("string")))
    docs = plain.unionByName(two).unionByName(two).unionByName(odd).unionByName(odd)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(str(tmp_path / str(k)))
        docs = stage(spark, spark.read.parquet(str(tmp_path / str(k))), SF)
        if name == "near-duplicates":
            rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
            assert len(rows) == len(set(rows)) and all(i is not None for i, _ in rows) and "component" in docs.columns
    assert docs.count() > 0


def test_repeated_rows_stay_once(spark):
    long_ = " ".join(f"w{k}" for k in range(50))
    rows = [(1, long_)] * 3 + [(1, "quite another text " * 9)] + [(2, long_ + " end"), (None, long_), (None, long_), (None, None), (3, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()))
    assert got == sorted([(1, long_), (1, "quite another text " * 9), (0, ""), (3, "alone")])


def test_no_text_goes_because_its_key_has_a_copy(spark):
    a, b, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abd")
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in [(1, a), (2, b), (2, a), (3, d)]], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect())
    assert got == [(1, a), (2, b), (3, d)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "labels", "benchmark"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    plain = lambda f: sorted(map(str, f[columns].astype(object).where(f[columns].notna(), None).itertuples(index=False, name=None)))
    assert plain(got) == plain(want)
