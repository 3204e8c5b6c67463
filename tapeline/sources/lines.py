"""Text files with true line numbers, without ever holding a file in one task.

Spark reads a file in blocks and numbers rows only within a task. A row is therefore placed by
(file, block start, order inside the block); counting the rows of earlier blocks gives its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeline.operators.scale import join_keys

BOM = "﻿"


def placed(df: DataFrame) -> DataFrame:
    """Adds file, block and pos to a frame read from files; must directly follow the read."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def number_rows(df: DataFrame, out: str = "line_no", keep: Column | None = None, first: int = 1) -> DataFrame:
    """Number the (kept) rows of each file in file order. Each window covers one block of a file."""
    rows = df if keep is None else df.where(keep)
    counts = rows.groupBy("file", "block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("file", "block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("pos"))
    numbered = join_keys(rows.withColumn("_in", inside), before, ["file", "block"])
    return numbered.withColumn(out, (F.col("_before") + F.col("_in") + (first - 1)).cast("bigint")).drop("_before", "_in")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value), one row per line; a byte order mark is removed."""
    lines = number_rows(placed(spark.read.text(path)))
    return lines.select("file", "line_no", F.regexp_replace("value", f"^{BOM}", "").alias("value"))
