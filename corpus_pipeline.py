"""A corpus pipeline: documents in, packed pieces out. Each stage reads what the one before it has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrafold.llm import exact, language, mixing, near, packing
from terrafold.llm.encode import vocabulary
from terrafold.llm.queries import END_ID
from terrafold.llm.store import documents, written


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.keep_identified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.keep_first(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near.keep_representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the sources' weights; a document taken twice stands twice."""
    return mixing.mixed_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), END_ID)


STAGES = [
    ("language_id", identified),
    ("exact_dedup", deduplicated),
    ("near_dedup", distinct),
    ("mixing", mixed),
    ("packing", packed),
]

#: Language ID, sampling keys and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
