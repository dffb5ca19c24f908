"""Documents to packed sequences: toxicity, near-duplicates, decontamination, personal data, packing.

Each stage takes the documents that the one before kept, as a written table, and all
but the last give documents with the same columns, whatever further columns these have.
Null and empty texts go through like any other, null ids too; repeated rows each keep
their result, but for near duplicates, of which one row stays. A text is one row, so a very
long one is worked on in one task at a time. Without documents there are no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.session import fresh_dir
from tidemark.llm import decontam, packing, pii, queries, simhash, toxicity
from tidemark.llm.text import free_name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold."""
    model = queries.toxicity_model(docs, queries.table(spark, sf_dir, "labels"))
    score = free_name("score", docs)
    return toxicity.scored(docs, model, score).where(F.col(score) < queries.TOXIC_FROM).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group."""
    return simhash.representatives(docs, width=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontam.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with spans of personal data replaced by their kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 4096 tokens."""
    return packing.pack_documents(docs, queries.tokenizer_path(), queries.SEQUENCE_TOKENS, queries.END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

#: The toxicity model, SimHash and the tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
