"""Session settings the jobs rely on; anything the cluster already sets is left alone."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tapeline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above. ``conf`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, whose workers import it by name; jobs that are submitted with
    ``--py-files`` or on workers that have it installed need not."""
    import shutil
    import tempfile
    from pathlib import Path

    root = Path(__file__).parent
    package = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tapeline-ship-')}/tapeline", "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(package)
