"""Corpus pipeline: language, civility, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame that is written as Parquet and reread as the next one's docs. Filtering stages keep the
columns of documents. A stage of an empty table is empty; null texts have no language and go at the
first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import language, overlap, packing, toxicity
from terrace.llm.common import new_path, table
from terrace.llm.tokens import default_tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return overlap.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, default_tokenizer())


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Learnt likelihoods, shingle hashes and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
