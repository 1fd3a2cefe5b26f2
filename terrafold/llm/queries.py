"""One query per operator, over whole tables, with production parameters; and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrafold.llm import binary, chat, counts, divergence, exact, fingerprints, language, licenses, mixing, near, packing, repeats, resample
from terrafold.llm.encode import vocabulary
from terrafold.llm.store import documents

END_ID = 2


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.maintain(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), counts.vocabularies())


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), END_ID)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.decide(documents(spark, sf_dir))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classify(documents(spark, sf_dir))


def op8_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), END_ID)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup(documents(spark, sf_dir))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_fingerprints, op3_license_scans, op4_chat_formatting, op5_packing, op6_exact_dedup,
    op7_minhash_near_dedup, op8_token_binary, op9_language_id, op10_mixing, op11_substring_dedup, op12_importance_resampling, op13_divergence_audit)}

ORACLES = {
    "op4_chat_formatting": chat.ORACLE,
    "op6_exact_dedup": exact.ORACLE,
    "op11_substring_dedup": repeats.ORACLE,
    "op13_divergence_audit": divergence.ORACLE,
}
