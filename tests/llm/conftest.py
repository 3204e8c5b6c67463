import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """(rows, schema) to a frame of run documents with a clashing extra column."""

    def make(rows, schema="path long, doc string"):
        from pyspark.sql import functions as F

        return spark.createDataFrame(rows, schema).withColumn("length", F.lit("clash")).withColumn("n", F.lit(1))

    return make
