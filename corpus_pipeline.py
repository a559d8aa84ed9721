"""The corpus pipeline: quality rules, SimHash near-dedup, suffix-array dedup,
benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet into the shared work folder and hands the next stage what it
reads back. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, quality, simhash, suffix
from tidemark.llm.queries import vocabulary_file, vocabulary_pattern
from tidemark.session import materialize, release, working_copies


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.filter_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_first(docs, width=4, max_bits=4, seed=42)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    return suffix.dedup_documents(docs, length=100)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold benchmark items."""
    return decontaminate.filter_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13, percent=5)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of ids and decoded bytes."""
    return bpe.token_digests(docs, vocabulary_file("byte_bpe_50k.tiktoken"), vocabulary_pattern(), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level bpe", byte_bpe),
]

#: Estimates, components, repeats and merges aren't expressed in SQL; the tests
#: hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. What a stage wrote for itself goes when its
    result is written, and that when the next stage's is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with working_copies(spark) as kept:
            docs, path = materialize(stage(spark, docs, sf_dir), f"pipeline{k}")
            kept.add(path)
        if before:
            release(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
