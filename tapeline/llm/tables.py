"""How the given tables stand for the library's records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def run_documents(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` as run documents: the id stands for the path."""
    table = spark.read.parquet(f"{sf}/documents.parquet")
    return table.select(F.col("doc_id").alias("path"), F.col("text").alias("doc"))


def crc_of(column: str) -> Column:
    """CRC-32 of the decimal text of an id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
