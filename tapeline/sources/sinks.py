"""Writers: curated table, warnings, JSON without NaN, assignments and centroids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.functions import numbers as N


def write_curated(df: DataFrame, path: str, fmt: str = "parquet", by: str = "_source") -> None:
    """Curated table, one folder per source; CSV carries a byte order mark in its header."""
    if fmt == "csv":
        first, *rest = [c for c in df.columns if c != by]
        marked = df.select(F.col(first).alias("﻿" + first), *rest, by)
        marked.write.mode("overwrite").partitionBy(by).csv(path, header=True)
    else:
        df.write.mode("overwrite").partitionBy(by).format(fmt).save(path)


def read_curated(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_warnings(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def safe_numbers(df: DataFrame) -> DataFrame:
    """NaN and infinities become NULL in every top-level floating column."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(*[N.finite(F.col(f.name)).alias(f.name) if isinstance(f.dataType, floating) else F.col(f.name) for f in df.schema.fields])


def to_safe_json(df: DataFrame) -> DataFrame:
    """One JSON text per row, NULLs written out, no NaN."""
    return safe_numbers(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_safe_json(df: DataFrame, path: str) -> None:
    """JSON lines; the commit of the write makes the new files visible at once."""
    to_safe_json(df).write.mode("overwrite").text(path)


def write_centroids(centroids: DataFrame, assignments: DataFrame, path: str) -> None:
    centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    assignments.write.mode("overwrite").parquet(f"{path}/assignments")
