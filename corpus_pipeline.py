"""A training corpus from raw documents: quality, exact and near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A
stage works on what its predecessor kept. Where a ``doc_id`` repeats with different texts, no text is lost: exact duplicates are dropped by id
and text, and near duplicates only if all rows of their id are. A row with a null ``doc_id`` is never dropped as a near duplicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shredline.llm import decontamination, exact_dedup, jaccard_join, packing, quality
from shredline.llm.common import Workspace, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good."""
    return quality.good_documents(spark, docs, table(spark, sf_dir, "labels"))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.without_duplicates(spark, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id."""
    return jaccard_join.without_near_duplicates(spark, docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(spark, docs, packing.word_tokenizer())


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_exact_duplicates),
    ("jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("best_fit_packing", pack_sequences),
]

#: The classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    space, docs = Workspace(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = space.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
