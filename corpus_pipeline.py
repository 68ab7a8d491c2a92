"""From raw documents to packed sequences, in stages that each call one operator.

run() writes every stage as Parquet in the shared folder and reads it again as the next
stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm import common, mixing, packing, quality, secrets, simhash


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the documents that the quality classifier keeps."""
    return quality.accepted(docs, common.table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each group of near duplicates, the one of smallest id."""
    return simhash.representatives(docs)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: all documents, with their secrets masked."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every document as often as the mix takes it, none, once or twice."""
    return mixing.taken(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", classify),
    ("near-dedup", deduplicate),
    ("secrets", scan_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained scorers, inferred automata and tokenisers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
