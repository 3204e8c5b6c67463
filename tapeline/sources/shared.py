"""The folder every executor reaches, and tables written there to cut the lineage of long plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared place the cluster names; a local session gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = root or tempfile.mkdtemp(prefix="tapeline-")
    return f"{root.rstrip('/')}/tapeline-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and a lost executor takes nothing with it."""
    where = scratch(df.sparkSession)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)
