"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and returns the columns of documents;
the last returns the packed pieces. Each is written as Parquet and read again
before the next, so a stage never repeats the work of those before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farebox.llm import mixing, packing, quality_rules, simhash, suffix_dedup
from farebox.llm.shared import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that repeat elsewhere; one may end empty."""
    return suffix_dedup.dedup_texts(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights take them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("suffix_dedup", repeats),
    ("mixing", mixture),
    ("packing", packed),
]

#: Fingerprints, suffix repeats and tokens are out of SQL's reach: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
