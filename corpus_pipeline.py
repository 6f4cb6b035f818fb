"""A corpus from raw documents to packed sequences, one stored stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from earshot.llm.langid import in_known_language
from earshot.llm.mixing import mixed_documents
from earshot.llm.packing import packed_documents
from earshot.llm.secrets import redacted
from earshot.llm.simhash import one_per_group
from earshot.workspace import scratch_root


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is known with some confidence."""
    return in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return one_per_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents and takes the secrets out of their texts."""
    return redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share of words, up to twice what it has."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; a row per piece."""
    return packed_documents(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("packing", packing),
]

# The network, the fingerprints and the tokenizer are beyond SQL; tests/llm/test_pipeline.py
# holds the stages against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_root(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
