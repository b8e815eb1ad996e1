"""Corpus pipeline: quality rules, classifier, near duplicates, long repeats, packing.

Each stage works on all that its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedhouse.llm import order_minhash, quality_net, rules
from feedhouse.llm.common import documents, settle_alone
from feedhouse.llm.packing import pack_documents
from feedhouse.llm.repeats import remove_repeats


# A passage of so many words is a long repeat, whatever its bytes.
REPEATED_WORDS = 51


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the cutoffs of their language and source."""
    return rules.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of documents that are still there."""
    return quality_net.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return order_minhash.keep_first(docs)


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the byte strings, and the runs of over 50 words, that occur more than once."""
    return remove_repeats(docs, words=REPEATED_WORDS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in token sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("long repeats", long_repeats),
    ("best-fit packing", best_fit_packing),
]

# A network, hash sketches and a genetic search are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settle_alone(lambda: stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
