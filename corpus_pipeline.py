"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next stage's documents; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesnet.llm import mil_quality, packing, rules_forest, simhash, source_mix
from salesnet.llm.common import shared_folder, small_batches, table
from salesnet.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the isolation forest reject go."""
    small_batches(spark)
    return rules_forest.passing(docs, table(spark, sf_dir, "labels"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of quality 0 go."""
    small_batches(spark)
    return mil_quality.good_documents(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    small_batches(spark)
    return simhash.without_near_copies(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their target shares."""
    return source_mix.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with the sequence and offset they are packed at."""
    small_batches(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("source mixing", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# SQL has no isolation forest, network, fingerprint or tokenizer: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; stages meet in Parquet in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/stage{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
