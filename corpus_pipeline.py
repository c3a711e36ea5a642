"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import jaccard, language, lines, mixing, packing
from wakeline.llm.common import read, remove, stored

#: A document is rejected when no language has this share of its letters.
LEAST_SCORE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from their labels; those without letters or in none go."""
    return language.keep_known(docs, LEAST_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are cut out; a document of which no word is left goes."""
    cut, removed = lines.with_removed(docs)
    left = (F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    n_chars = F.when(F.col(removed) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.where(left).withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return jaccard.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack_texts(docs)


STAGES = [
    ("language", known_language),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: Learned labels and tokens are beyond SQL; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        remove(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
