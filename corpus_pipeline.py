"""A training corpus from raw documents, in four stages.

1. quality rules (operator 2): rejected documents go;
2. toxicity (operator 8): toxic documents go;
3. near-duplicates by MinHash (operator 5; five words, similarity 0.8): of each group the row with the least doc_id stays;
4. best-fit packing (operator 7) of what is left, one row per piece.

Each stage reads all rows that the stage before it kept, and returns them with the columns of ``documents``; the last
returns the packing. Null and repeated rows have each operator's defined results. Near-duplicates are found among
texts, whatever their keys: of rows that repeat a doc_id with its text one stays, a row never goes because another row
of its doc_id is a copy, and of a group whose rows all lack a doc_id one stays. An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eligo.llm import neardup, packing, quality, toxicity
from eligo.llm.common import fresh_dir, table

#: No SQL: the verdicts rest on fitted models, hashed sketches and a tokenizer.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.judged(docs, model).filter("not toxic").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; between them, rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            at = fresh_dir(spark, f"stage{k}")
            docs.write.parquet(at)
            docs = spark.read.parquet(at)
    return docs
