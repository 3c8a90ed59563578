"""A training-data pipeline over ``documents``: quality, lines, near-duplicates, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labtide.llm import decontaminate, line_dedup, minhash, packing, quality
from labtide.llm.queries import tokenizer
from labtide.llm.staging import staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share."""
    return line_dedup.without_repeated_lines(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, on shingles of five words."""
    return minhash.one_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 2048 tokens."""
    return packing.packed_documents(docs, tokenizer())


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_shared_lines),
    ("minhash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

# No stage but the second can be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each over what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, f"stage-{number}")
    return docs
