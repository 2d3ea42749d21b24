"""From documents to token ids: language, near duplicates, repeated passages, benchmark items, byte-level BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terravia.llm import bpe, decontaminate, language, near_duplicates, passages
from terravia.llm.rows import table
from terravia.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def accept_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain enough."""
    return language.accepted_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the passages that an earlier one has."""
    return passages.without_passages(docs)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document's text."""
    return bpe.encode(docs, RANKS, public_tokenizers.PATTERN).drop("text", "n_chars")


STAGES = [
    ("language", accept_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("benchmark_items", drop_benchmark_items),
    ("byte_bpe", encode),
]
#: Near duplicates and passages are not expressible in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
