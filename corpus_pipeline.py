"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes what its predecessor kept, is written as Parquet to the shared folder and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm import exact_dedup, ngram_join, packing, substring_dedup, toxicity
from tierloom.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a machine trained on the labelled ones outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(toxicity.fold_of(F.col("doc_id"), 3) != 1)
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal without white space."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram links join."""
    return ngram_join.drop_near_duplicates(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere, too."""
    return substring_dedup.cut_passages(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    return packing.pack_documents(docs, keep_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("best_fit_packing", pack),
]

#: A trained classifier, token ids and substring removal one after the other have no SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
