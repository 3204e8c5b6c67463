"""Sums over partitions and monotone calibration, shared by the classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tapeline.llm import shared

SUM = "sums binary"
FAN_IN = 32


def partition_sums(
    df: DataFrame, size: int, add: Callable[[np.ndarray, pa.RecordBatch], None], finish: Callable[[np.ndarray], np.ndarray] | None = None
) -> np.ndarray:
    """The total of a fixed-size vector over all rows: ``add`` accumulates batches inside a task, and the vectors
    of the tasks are summed ``FAN_IN`` at a time, so neither a task nor the driver ever holds many of them. ``finish`` turns the
    total into what the driver needs, where the total is."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                seen = True
                add(total, batch)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])
        shared.give_back()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in batches:
            for blob in batch.column(0):
                total += np.frombuffer(blob.as_py())
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    tasks = df.rdd.getNumPartitions()
    sums = df.mapInArrow(each, SUM)
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        sums = sums.repartition(tasks).mapInArrow(merge, SUM)
    finish = finish or (lambda total: total)
    kind = finish(np.zeros(size)).dtype

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [finish(np.frombuffer(blob.as_py())).tobytes() for blob in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], names=["sums"])

    row = sums.mapInArrow(last, SUM).first()  # one row, or none
    return np.frombuffer(bytes(row[0]), dtype=kind) if row else finish(np.zeros(size))


def known_labels(labels: DataFrame, label: str, fit_rows: int) -> DataFrame:
    """(path, label 0/1) of about ``fit_rows`` labelled paths, chosen by the hash of the path. NULL paths and labels
    are left out; a path that is named twice counts once, by its mean."""
    known = labels.where(F.col("path").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("path").agg((F.avg(label) >= 0.5).cast("int").alias(label))
    share = min(1.0, fit_rows / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64(F.lit("fit"), F.col("path").cast("string")), F.lit(1 << 20)) < share * (1 << 20))


def commonest(counted: DataFrame, key: str, n: str, most: int) -> dict:
    """The keys with the largest counts, at most ``most`` of them; keys at the border that would be too many all
    stay out, so the result does not depend on their order. Only the counts' histogram and the result reach the
    driver. ``counted`` is a written table."""
    level = F.floor(F.log2(F.col(n).cast("double")) * 16)
    least, total = None, 0
    for row in sorted(counted.where(F.col(n) > 0).groupBy(level.alias("level")).count().collect(), key=lambda r: -r.level):
        total += row["count"]
        if total > most:
            break
        least = row.level
    if least is None:
        return {}
    return {r[key]: r[n] for r in counted.where(level >= least).select(key, n).collect()}


def isotonic(ones: np.ndarray, counts: np.ndarray, prior: float = 1.0) -> np.ndarray:
    """Non-decreasing rates of fixed score bins by pooling adjacent violators; empty bins take no part and get
    the interpolated rate. Each pool is drawn towards the overall rate by ``prior`` rows."""
    if counts.sum() == 0:
        return np.full(len(counts), 0.5)
    overall = ones.sum() / counts.sum()
    pools: list[list[float]] = []  # rate, ones, count, last bin
    for i in np.flatnonzero(counts):
        pools.append([ones[i] / counts[i], ones[i], counts[i], i])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            _, a, b, _ = pools.pop(-2)
            pools[-1][1] += a
            pools[-1][2] += b
            pools[-1][0] = pools[-1][1] / pools[-1][2]
    rates = np.zeros(len(counts))
    start = 0
    for _, a, b, last in pools:
        rates[start : last + 1] = (a + prior * overall) / (b + prior)
        start = last + 1
    rates[start:] = rates[start - 1]
    return np.maximum.accumulate(rates)
