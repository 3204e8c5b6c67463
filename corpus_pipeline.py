"""Corpus pipeline: quality, toxicity, near duplicates, secrets, packing; each stage works on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tapeline.llm import jaccard, packing, quality, secret_scan, shared, toxicity
from tapeline.llm.tables import crc_of, vocabulary_file


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("accepted"))
    return quality.accepted_documents(docs, labels, F.pmod(crc_of("path"), F.lit(4)) != 2, "doc_id", "text")


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.clean_documents(docs, labels, F.pmod(crc_of("path"), F.lit(5)) != 0, "doc_id", "text")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return jaccard.one_of_each(docs, "doc_id", "text")


def documents_without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts, whose lengths follow."""
    masked = secret_scan.redacted(docs, None, "doc_id", "text")
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenized and packed into sequences: a row per piece."""
    return packing.pack_documents(docs, vocabulary_file("byte_bpe_50k.json"), "doc_id", "text")


STAGES = [
    ("quality classifier", good_documents),
    ("toxicity", civil_documents),
    ("n-gram Jaccard join", distinct_documents),
    ("secret scans", documents_without_secrets),
    ("best-fit packing", packed_sequences),
]
ORACLE_SQL = None  # tokenizers and fitted models are beyond SQL; the tests compare with single steps


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
