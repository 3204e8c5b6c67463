"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tapeline.llm import shared

CHUNK = 100_000  # edges a task contracts at a time


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components and far fewer steps to go: each task replaces the edges of a chunk by
    stars around the smallest node that they connect."""

    out = shared.arrow_schema(edges.schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.chunks(batches, CHUNK):
            parent: dict = {}

            def root(x):
                while parent.setdefault(x, x) != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            stars = [(x, root(x)) for x in parent if root(x) != x]
            if stars:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*stars), out.types)], schema=out)

    return edges.mapInArrow(each, edges.schema)


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The written edges, and a count and a hash sum that change with them."""
    seen = Observation()
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    kept = shared.written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("h")), name)
    return kept, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, name: str = "edges", most_rounds: int = 100) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Each round hangs every node on the smallest node its neighbours know, then makes the trees flat; the edge
    table is written each round, so plans stay short. Ends when a round changes nothing. Hot nodes only meet
    map-side combined minima and plain joins, which Spark splits. NULL nodes are left out.
    """
    real = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, last = _written(contracted(real).distinct(), name)
    for _ in range(most_rounds):
        pairs = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = pairs.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # now every a > b: hang the smaller neighbours of a on the smallest of them
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        flat = large.join(small, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now, seen = _written(flat.where("a <> b").distinct(), name)
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError("components did not settle")
    leaves = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = now.select(F.col("b").alias("node")).distinct().join(leaves.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return leaves.union(roots)
