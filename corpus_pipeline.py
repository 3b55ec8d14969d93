"""From raw documents to packed training sequences.

Each stage calls one operator of ``rategrid.llm`` on what the stage before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rategrid.llm import language, lines, packing, quality, simhash
from rategrid.llm.store import stash


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the corpus declares."""
    return language.keep_known(docs, language.train(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others, or they themselves, have before."""
    return lines.drop_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", drop_poor),
    ("language", drop_unknown_language),
    ("lines", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: Trained models, fingerprints and edit distances are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and reread as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
    return docs
