"""A training corpus from raw documents: the stages, each one an operator of the library.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
to the shared folder and read again as the documents of the next. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from answerclock.llm import decontaminate, dedup_minmax, language_id, mixing, token_binary
from answerclock.llm.registry import END_ID, tokenizer_path
from answerclock.operators.storage import stored

# Least similarity of near duplicates, on shingles of five words.
NEAR_PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language_id.accepted(docs, language_id.fit(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return dedup_minmax.deduplicated(docs, least_percent=NEAR_PERCENT)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in ascending order of documents, and what is read back."""
    return token_binary.round_trip(docs, tokenizer_path(), END_ID)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmarks),
    ("mixing", target_mix),
    ("token_binary", token_files),
]

# Centroids and token ids have no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
