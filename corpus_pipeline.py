"""The training-text pipeline: each stage reads what the stage before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import minhash, mixing, packing, quality, suffixes
from tradewind.llm.common import stage, table


# Passages of 50 words are seldom shorter.
REPEAT_BYTES = 250


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the least id."""
    return minhash.drop_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in strings of ``REPEAT_BYTES`` that occur elsewhere go from the texts; rows all stay."""
    return suffixes.without_repeats(docs, REPEAT_BYTES)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the fair schedule; those of small sources come again where
    their source's weight asks for it."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents and the sequences they are packed into."""
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("minhash_near_dedup", without_near_copies),
    ("suffix_array_dedup", without_repeats),
    ("mixing_to_weights", mixed),
    ("best_fit_packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "zstd")
    return docs


# A trained classifier and a tokenizer's files are no SQL.
ORACLE_SQL = None
