"""Connected components of an edge table, in rounds of contraction that are written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.operators.scale import join_keys
from tapeline.sources.shared import written

MOST_ROUNDS = 60


def _stars(n_keys: int):
    """Edges of a batch as stars around the smallest node that they connect: same components, no more rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            group = list(zip(*columns[:n_keys])) if n_keys else [()] * batch.num_rows
            above: dict = {}

            def top(node):
                while above.setdefault(node, node) != node:
                    above[node] = node = above[above[node]]
                return node

            for key, a, b in zip(group, *columns[n_keys:]):
                p, q = top((key, a)), top((key, b))
                if p != q:  # of one group, so the numbers decide
                    above[p if p[1] > q[1] else q] = q if p[1] > q[1] else p
            rows = [(*node[0], node[1], top(node)[1]) for node in list(above) if top(node) != node]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), batch.schema.types)], schema=batch.schema)

    return run


def connected_components(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, node, component) of every node of ``edges`` (``by``, a, b): nodes are longs, known within their group
    ``by``; the component is its smallest node.

    In a round every node moves to its smallest neighbour and edges follow their ends, until no edge is left; what moved
    where is written each round, so plans stay short and a lost executor costs one task. Before a round, each batch of
    edges is replaced by stars, which settles small groups at once. No group is held in a task: a group with
    a third of all edges is spread over all of them. A node beside itself only (a = b), or beside NULL, has no row.
    """
    by = list(by)
    order = lambda df: df.where("a <> b").select(*by, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    contract = lambda df: written(df.mapInArrow(_stars(len(by)), df.schema))
    now = contract(order(edges.select(*by, F.col("a").cast("long"), F.col("b").cast("long"))))
    labels = None
    for _ in range(MOST_ROUNDS):
        if now.isEmpty():
            break
        ends = now.select(*by, F.col("a").alias("node"), F.col("b").alias("near")).unionAll(
            now.select(*by, F.col("b").alias("node"), F.col("a").alias("near"))
        )
        moved = written(ends.groupBy(*by, "node").agg(F.least("node", F.min("near")).alias("to")))
        to = lambda c: moved.select(*by, F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        if labels is None:
            labels = moved.withColumnRenamed("to", "component")
        else:
            labels = join_keys(labels, to("component"), [*by, "component"], "left", "merge").withColumn(
                "component", F.coalesce("component_to", "component")
            ).drop("component_to")
        followed = join_keys(join_keys(now, to("a"), [*by, "a"], hint="merge"), to("b"), [*by, "b"], hint="merge")
        now = contract(order(followed.select(*by, F.col("a_to").alias("a"), F.col("b_to").alias("b"))).distinct())
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return labels if labels is not None else now.select(*by, F.col("a").alias("node"), F.col("b").alias("component"))
