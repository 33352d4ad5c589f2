"""Corpus pipeline over ``documents``: quality rules, near-duplicates, benchmark
decontamination, personal data, packing.

Each stage takes all rows the one before kept, written as Parquet and read
again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartpulse.llm.common import stored, table
from cartpulse.llm.decontaminate import decontaminate
from cartpulse.llm.packing import pack
from cartpulse.llm.pii import redact
from cartpulse.llm.quality_rules import clean_documents
from cartpulse.llm.simhash import dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; rejected documents go."""
    return clean_documents(docs, length_col="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the smallest doc_id."""
    return dedup(docs, shingle_words=3, max_bits=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return redact(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches."""
    return pack(docs, buckets=16, budget=16_384)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("personal_data", personal_data), ("packing", packing)]

#: Fingerprints and the random field cannot be written in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
