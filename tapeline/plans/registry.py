"""The query catalogue: each entry is a Spark plan over the tables and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register a plan under ``name``; ``ops`` lists the inventory ids it covers."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        OPERATORS[name] = ops
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input comes in fewer splits than there are cores.

    A table of many files has more splits than that and passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over tasks by ``key``, for work per row that costs far more than a shuffle.

    Splits tell little about a table's tasks: a row group is read by one task, so a file of one row group is one task's
    work however many splits it has.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())
    return df.repartition(4 * tasks, key)
