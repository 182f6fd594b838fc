"""The corpus pipeline: each stage takes what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. Each runs one of the operators of ``tidemill.llm`` over the whole texts.
Nulls, empty and very long texts, repeated rows, empty tables and further columns are treated
as the operators' docstrings say; a table without rows passes through all stages as such.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import decontaminate, exact_dedup, packing, quality, simhash
from tidemill.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of three words, two bits."""
    return simhash.drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 2048 tokens."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("exact_dedup", distinct),
    ("simhash", different),
    ("decontaminate", clean),
    ("packing", packed),
]

# a classifier, fingerprints and a tokenizer are not SQL; tests/llm holds brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = materialize(stage(spark, rows, sf_dir), name)
    return rows
