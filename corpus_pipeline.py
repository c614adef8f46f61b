"""The corpus pipeline: quality rules, near-duplicates, repeated passages, source mix, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before left; all but the last return the
columns of documents. ``run`` writes each stage's result as Parquet in the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wickwork.llm import mixing, packing, quality, simhash, suffix
from wickwork.llm.common import keep, release, scratch, table
from wickwork.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without boilerplate lines."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity of 0.8 or more."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings that start earlier in the corpus."""
    return suffix.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes them."""
    return mixing.Mix(docs).documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their places in sequences."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

#: Interval expansion, permutations and byte-pair merges are not SQL; tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before = docs
        with scratch(spark):  # a stage's own tables go when its result is written
            docs = keep(stage(spark, before, sf_dir))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
