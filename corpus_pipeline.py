"""From raw documents to packed training sequences, in five stages.

``run`` writes what each stage keeps to the cluster's shared folder and reads it back, so a stage
works on all that its predecessor kept and a lost executor costs tasks, not stages.

All stages take nulls in any column (a null text counts as an empty one), very long texts, repeated rows,
further columns of any name, and empty tables, which give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlens.llm import exact_dedup, langid, quality, queries, simhash
from sensorlens.session import hold


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the language models don't reject. Texts without a letter, null and empty ones
    are rejected; rows that share a ``doc_id`` stay if one does, rows without one stay."""
    return langid.keep_known(docs, langid.learn(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.3, null and empty texts like any others; without labels all stay.
    Rows that share a ``doc_id`` stay if one does, rows without one stay."""
    labels = queries.table(spark, sf_dir, "labels")
    return quality.keep_good(docs, quality.learn(docs, labels), least=0.3)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest ``doc_id``, and once if it
    is repeated. A row without ``doc_id`` stays only if no row with one has its text."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest ``doc_id``. Rows that
    share a ``doc_id`` stay if one does, rows without one stay."""
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens; a null or empty text is its end id alone."""
    return queries.packed(docs)


STAGES = [
    ("language ID", known_language),
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("packing", packed),
]

# Language models, a trained network, fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    *filters, last = STAGES
    for name, stage in filters:
        docs = hold(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last[1](spark, docs, sf_dir)
