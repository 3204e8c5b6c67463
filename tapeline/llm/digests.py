"""Quartile bucket digests of run documents, and how alike a document is to its edited text and to the next one."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import shared

BUCKETS = 512
HEAD = 6  # hexadecimal characters before the bucket codes: length, two quartile ratios
# Difference of two quartile codes: neighbours 1, two apart 2, the extremes 6; its mean over unequal-to-zero pairs.
_STEP = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]])
_MEAN = _STEP.sum() / 15


def fingerprint(text: str) -> str:
    """Hexadecimal digest: a step of the logarithm of the length, the ratios of the count quartiles, and for each
    bucket of hashed byte triplets the quartile of its count. Two marks before and behind the text give even the
    shortest text triplets, so different short texts differ."""
    raw = text.encode("utf-8", "surrogatepass")
    b = np.frombuffer(b"\xff\xff" + raw + b"\xff\xff", dtype=np.uint8).astype(np.uint32)
    h = b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA77) ^ b[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    counts = np.bincount(h % np.uint32(BUCKETS), minlength=BUCKETS)
    ordered = np.sort(counts)
    low, middle, high = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = ((counts > low).astype(np.uint8) + (counts > middle) + (counts > high)).reshape(-1, 4)
    body = (codes[:, 0] << 6 | codes[:, 1] << 4 | codes[:, 2] << 2 | codes[:, 3]).astype(np.uint8).tobytes()
    ratio = lambda q: min(255, 255 * q // high) if high else 0
    return f"{min(255, round(math.log(len(raw) + 1, 1.1))):02x}{ratio(low):02x}{ratio(middle):02x}" + body.hex()


def _codes(print_: str) -> np.ndarray:
    body = np.frombuffer(bytes.fromhex(print_[HEAD:]), dtype=np.uint8)
    return np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], axis=1).ravel()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, towards 0 for unrelated ones: 1 less the bucket differences, taken relative to what
    unrelated buckets differ by, less a little for different lengths and quartile ratios."""
    if a == b:
        return 1.0
    x, y = _codes(a), _codes(b)
    used = int(((x > 0) | (y > 0)).sum())
    gap = _STEP[x, y].sum() / (_MEAN * max(1, used))
    length, low, middle = (abs(int(a[i : i + 2], 16) - int(b[i : i + 2], 16)) for i in (0, 2, 4))
    gap += 0.01 * max(0, length - 1) + 0.05 * (low + middle) / 255
    return float(min(1.0, max(0.0, 1 - gap)))


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by as many from the start of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _compared(text: str, own: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following)
    after = fingerprint(changed)
    return (len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, after,
            likeness(own, after), likeness(own, next_print))


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def document_digests(documents: DataFrame, path: str = "path", doc: str = "doc") -> DataFrame:
    """One row per run document: ``path``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents are taken in ascending order of path (NULL first, repeated paths by the hash of their text); the last
    one is followed by the first. Texts are shuffled once, into ranges of paths that are streamed in order; only
    the first and the last text of each range meet in a second, small step.
    NULL documents are empty texts; a single document is followed by itself; repeated rows each have a row. An
    empty table gives no rows. Other columns are ignored.
    """
    source = documents.select(F.col(path).alias("path"), F.coalesce(doc, F.lit("")).alias("doc"))
    key = T.StructField("path", source.schema["path"].dataType)
    result = [key, *T._parse_datatype_string(RESULT).fields]
    edge = T._parse_datatype_string("part int, first string, last string").fields
    schema = T.StructType([*result, *edge])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = shared.arrow_schema(schema)
        first = held = None
        for batch in shared.chunks(batches):
            rows = []
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = fingerprint(row[1])
                if held is None:
                    first = row[1]
                else:
                    rows.append((held[0], *_compared(held[1], held[2], row[1], own), None, None, None))
                held = (*row, own)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)
        if held is not None:
            row = (held[0], *[None] * 6, TaskContext.get().partitionId(), first, held[1])
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, out.types)], schema=out)

    tie = F.xxhash64("doc")
    ranges = source.repartitionByRange("path", tie).sortWithinPartitions("path", tie, "doc")
    found = shared.written(ranges.mapInArrow(stream, schema), "digests")
    edges = found.where("part IS NOT NULL").select("path", "part", "first", "last")  # one row per range
    order = edges.select("part").withColumn("next", F.lead("part").over(Window.orderBy("part")))
    order = order.withColumn("next", F.coalesce("next", F.min("part").over(Window.partitionBy())))
    pairs = edges.select("path", "part", "last").join(order, "part").join(edges.select(F.col("part").alias("next"), "first"), "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(T.StructType(result))
        for batch in shared.chunks(batches, 100):
            rows = [(p, *_compared(last, fingerprint(last), first, fingerprint(first)))
                    for p, last, first in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    names = [f.name for f in result]
    closed = pairs.select("path", "last", "first").mapInArrow(close, T.StructType(result))
    return found.where("part IS NULL").select(*names).union(closed).withColumnRenamed("path", path)
