"""Standardise, cluster and describe subjects."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


from tapeline.operators.scale import order_stats

CENTROID_CELLS = 2_000_000  # cells that ship with a task at once
SEEDINGS = 4  # starts that are drawn at the same time
MATRIX_ROWS = 4096  # rows kept as one matrix
SUMS, SUM_ROWS, ADDERS = "start int, first int, sums binary", 64, 8  # clusters summed up together, and by how many tasks
ASSIGN = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("sq_dist", T.DoubleType())])


def zscore(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Columns minus mean over population deviation (0 becomes 1); the parameters fit on the driver.

    They are rounded to 12 digits, so that the order of partial sums does not show in the result."""
    aggs = [F.round(f(c), 12).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(*aggs).first()
    params = {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in cols}
    z = df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in params.items()})
    return z, params


def assign(df: DataFrame, cols: Sequence[str], centroids: np.ndarray) -> DataFrame:
    """Nearest centroid of each row (the lowest index wins a tie) and the squared distance.

    ``centroids`` is k x d and ships with the task, a block of at most ``CENTROID_CELLS`` cells at a time; the
    rows never move.
    """
    rows = max(1, CENTROID_CELLS // max(1, centroids.shape[1]))
    out = df
    for start in range(0, len(centroids), rows):
        near = _nearest(centroids[start : start + rows], start)(*[F.col(k) for k in cols])
        out = out.withColumn("_near", near)
        if start:
            out = out.withColumn("_best", F.when(F.col("_near.sq_dist") < F.col("_best.sq_dist"), F.col("_near")).otherwise(F.col("_best")))
        else:
            out = out.withColumn("_best", F.col("_near"))
    return out.select(*df.columns, "_best.*")


def nearest_rows(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``c`` (the lowest wins a tie) and the squared distance, for each row of ``x``.

    A matrix product tells which centroids are near enough to be it, within far more than its rounding error; the
    distances to those few are then summed column by column, so results and ties are those of comparing them all.
    """
    with np.errstate(all="ignore"):
        c2, x2 = (c * c).sum(axis=1), (x * x).sum(axis=1)
        rough = c2 - 2 * (x @ c.T) + x2[:, None]
        near = rough <= (rough.min(axis=1) + 1e-11 * (x2 + c2.max()))[:, None]
        near[~(np.isfinite(rough).all(axis=1) & near.any(axis=1))] = True
        row, col = np.nonzero(near)
        d = np.zeros(len(row))
        for j in range(x.shape[1]):
            d += (x[row, j] - c[col, j]) ** 2
    least = np.minimum.reduceat(d, np.flatnonzero(np.diff(row, prepend=-1)))
    hit = np.flatnonzero((d == least[row]) | np.isnan(d))
    return col[hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]], least


def _nearest(centroids: np.ndarray, first: int):
    c = np.ascontiguousarray(centroids, dtype=float)

    @F.pandas_udf(ASSIGN)
    def nearest(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for parts in batches:
            x = np.column_stack([p.to_numpy(dtype=float) for p in parts])
            idx, dist = np.empty(len(x), dtype=np.int32), np.empty(len(x))
            step = max(1, 2_000_000 // max(len(c), 1))
            for lo in range(0, len(x), step):
                idx[lo : lo + step], dist[lo : lo + step] = nearest_rows(x[lo : lo + step], c)
            yield pd.DataFrame({"cluster": idx + first, "sq_dist": dist})

    return nearest


def lloyd(df: DataFrame, cols: Sequence[str], k: int, order: Sequence[str], max_iter: int = 300, tol: float = 1e-12) -> np.ndarray:
    """Deterministic k-means: the first ``k`` rows in order start; an empty cluster keeps its centroid.

    Each round is one map pass and one combined aggregation of k rows. The centroids live on the
    driver, so the plan never grows. Means are rounded to 12 digits: the order in which partial sums
    meet cannot change a later assignment.
    """
    data = df.select(*dict.fromkeys([*order, *cols])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        start = data.orderBy(*order).limit(k).select(*cols).collect()
        centroids = np.array([list(r) for r in start], dtype=float)
        for _ in range(max_iter):
            means = (
                assign(data, cols, centroids).groupBy("cluster").agg(*[F.round(F.avg(c), 12).alias(c) for c in cols]).collect()
            )
            moved = centroids.copy()
            for r in means:
                moved[r["cluster"]] = [r[c] for c in cols]
            done = np.abs(moved - centroids).max() <= tol
            centroids = moved
            if done:
                break
        return centroids
    finally:
        data.unpersist()


def library_kmeans(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42, restarts: int = 10, max_iter: int = 100, tol: float = 1e-4) -> np.ndarray:
    """MLlib k-means, the best of several seeded starts.

    MLlib draws the first centroids of each seed (k-means||). The rounds are MLlib's too, but those of all starts go through
    the rows together, as matrix products: MLlib starts a job of up to 1024 tasks in each round to compare centroids.
    """
    from pyspark import inheritable_thread_target
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=list(cols), outputCol="features").transform(df).select("features")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        data.count()  # before several starts at once ask for it

        def start(i: int) -> np.ndarray:
            return np.array(KMeans(k=k, seed=seed + i, maxIter=0).fit(data).clusterCenters())

        with ThreadPoolExecutor(SEEDINGS) as pool:
            jobs = [pool.submit(inheritable_thread_target(df.sparkSession)(start), i) for i in range(restarts)]
            starts = [j.result() for j in jobs]
    finally:
        data.unpersist()
    rows = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)]).mapInArrow(_packed, "x binary")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _library_rounds(rows, starts, max_iter, tol)
    finally:
        rows.unpersist()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as matrices."""
    for batch in batches:
        for lo in range(0, batch.num_rows, MATRIX_ROWS):
            part = batch.slice(lo, MATRIX_ROWS)
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns])
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x, dtype=float).tobytes()], pa.binary())], ["x"])


def _library_rounds(rows: DataFrame, centroids: list[np.ndarray], max_iter: int, tol: float) -> np.ndarray:
    """Rounds of each start until no centroid moves further than ``tol``; the centroids of the start with the least cost.

    As in MLlib an empty cluster keeps its centroid, and the cost is that of the last round's assignments. Means are
    rounded to 12 digits, as in ``lloyd``."""
    costs = np.full(len(centroids), np.inf)
    going = list(range(len(centroids)))
    for _ in range(max_iter):
        if not going:
            break
        sums = rows.mapInArrow(_partial_sums({i: centroids[i] for i in going}), SUMS)
        sums = sums.repartition(ADDERS, "start", "first").mapInArrow(_added, SUMS)
        total = {i: np.zeros((len(centroids[i]), centroids[i].shape[1] + 2)) for i in going}
        for r in sums.collect():
            part = np.frombuffer(r.sums).reshape(-1, total[r.start].shape[1])
            total[r.start][r.first : r.first + len(part)] = part
        still = []
        for i, found in total.items():
            some = found[:, -2] > 0
            moved = centroids[i].copy()
            moved[some] = (found[some, :-2] / found[some, -2:-1]).round(12)
            costs[i] = found[:, -1].sum()
            if ((moved - centroids[i]) ** 2).sum(axis=1).max() > tol * tol:
                still.append(i)
            centroids[i] = moved
        going = still
    return centroids[int(costs.argmin())]


def _partial_sums(centroids: dict[int, np.ndarray]):
    """Sums, number and cost of the rows nearest to each centroid of each start; of equally near ones the first."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = next(iter(centroids.values())).shape[1]
        squares = {i: (c * c).sum(axis=1) for i, c in centroids.items()}
        doubled = {i: np.ascontiguousarray(-2 * c.T) for i, c in centroids.items()}
        total = {i: np.zeros((len(c), dims + 2)) for i, c in centroids.items()}
        for batch in batches:
            for buffer in batch.column(0):
                x = np.frombuffer(buffer.as_buffer()).reshape(-1, dims)
                x2 = (x * x).sum(axis=1)
                for i in centroids:
                    near = np.empty(len(x), dtype=np.int64)
                    cost = np.empty(len(x))
                    for lo in range(0, len(x), 512):
                        d = x[lo : lo + 512] @ doubled[i]
                        d += squares[i]
                        near[lo : lo + 512] = n = d.argmin(axis=1)
                        cost[lo : lo + 512] = d[np.arange(len(n)), n]
                    by = np.argsort(near, kind="stable")
                    first = np.flatnonzero(np.diff(near[by], prepend=-1))
                    own = near[by[first]]
                    total[i][own, :-2] += np.add.reduceat(x[by], first, axis=0)
                    total[i][:, -2] += np.bincount(near, minlength=len(total[i]))
                    total[i][:, -1] += np.bincount(near, weights=np.maximum(cost + x2, 0), minlength=len(total[i]))
        for i, found in total.items():
            yield _sums_batch([(i, lo, found[lo : lo + SUM_ROWS]) for lo in range(0, len(found), SUM_ROWS)])

    return each


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums over all tasks."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for *key, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            part = np.frombuffer(sums.as_buffer())
            total[*key] = total[*key] + part if tuple(key) in total else part
    if total:
        yield _sums_batch([(*key, part) for key, part in total.items()])


def _sums_batch(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    start, first, sums = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(start, pa.int32()), pa.array(first, pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], ["start", "first", "sums"])


def to_original_scale(centroids: np.ndarray, cols: Sequence[str], params: dict[str, tuple[float, float]]) -> np.ndarray:
    m = np.array([params[c][0] for c in cols])
    s = np.array([params[c][1] for c in cols])
    return centroids * s + m


def centroid_frame(spark, centroids: np.ndarray, cols: Sequence[str]) -> DataFrame:
    rows = [(i, *map(float, c)) for i, c in enumerate(centroids)]
    return spark.createDataFrame(rows, "cluster int, " + ", ".join(f"c_{c} double" for c in cols))


def original_distance(assigned: DataFrame, centroids: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distance to the assigned centroid in original units (k rows of centroids, size-checked above)."""
    d = F.lit(0.0)
    for c in cols:
        d = d + (F.col(c) - F.col(f"c_{c}")) * (F.col(c) - F.col(f"c_{c}"))
    return assigned.join(F.broadcast(centroids), "cluster").withColumn("distance", F.sqrt(d))


def assignment_stats(distances: DataFrame) -> DataFrame:
    """Distance and cluster-size order statistics over all assigned rows."""
    d = order_stats(distances, [], "distance", {"p50": 0.5, "p90": 0.9})
    sizes = distances.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    s = order_stats(sizes, [], "n", {"p50": 0.5})
    return d.select(
        "n_rows", F.col("min_value").alias("dist_min"), F.col("p50").alias("dist_p50"), F.col("p90").alias("dist_p90"),
        F.col("max_value").alias("dist_max"),
    ).crossJoin(
        F.broadcast(s.select(F.col("n_rows").alias("n_clusters"), F.col("min_value").alias("size_min"),
                             F.col("p50").alias("size_p50"), F.col("max_value").alias("size_max")))
    )


def worst_subjects(distances: DataFrame, id_col: str, k: int = 10) -> DataFrame:
    return distances.orderBy(F.desc(F.round("distance", 9)), id_col).limit(k)


