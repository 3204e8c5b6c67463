"""Small helpers of the corpus operators: the shared folder, written tables, Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: ``spark.checkpoint.dir``; only a local session may go without."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        place = spark._jvm.org.apache.hadoop.fs.Path(named)  # with its scheme, which executors' own libraries need
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return "file://" + tempfile.mkdtemp(prefix="tapeline-")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and lost executors do not matter."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def texts(column) -> list[str]:
    """The texts of an Arrow column; NULL counts as empty."""
    return [t or "" for t in column.to_pylist()]


def give_back() -> None:
    """Return free memory to the system: a worker lives on, and would keep what its largest batch has needed."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def chunks(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that what a task holds beside its input stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def sized_chunks(batches: Iterator[pa.RecordBatch], column: int, size: int, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows whose texts in ``column`` have together at most ``size`` bytes, or of one longer text."""
    import pyarrow.compute as pc

    for batch in batches:
        filled = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = filled[start - 1] if start else 0
            stop = min(max(int(np.searchsorted(filled, before + size, side="right")), start + 1), start + rows)
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def kept_rows(documents: DataFrame, doc: str, keep: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """The rows whose text ``keep`` says yes to, as they are; the texts stay where they are read."""
    at = documents.columns.index(doc)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield batch.filter(pa.array(np.asarray(keep(texts(batch.column(at))), dtype=bool)))

    return documents.mapInArrow(each, documents.schema)
