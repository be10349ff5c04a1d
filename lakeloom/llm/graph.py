"""Connected components of a distributed edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, saved


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over one batch of edges: each node but the roots with its root, the smallest node."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    n = len(u)
    for a, b in zip(ends[:n].tolist(), ends[n:].tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    roots = np.array([find(x) for x in range(len(nodes))])
    moved = roots != np.arange(len(nodes))
    return nodes[moved], nodes[roots[moved]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            u, v = _forest(b.column("u").to_numpy(), b.column("v").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # saved, so that a node with very many neighbours is a join's skewed key that Spark can split
    least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = saved(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    rest = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have an edge; component is the smallest node reached.

    edges: u, v long. Each task first joins its own edges by union-find; what remains across tasks
    is tied by alternating large and small stars, each a grouped minimum and a join, until the
    edges form stars. Every round is a saved table, so no lineage grows.
    """
    now = saved(edges.filter("u <> v").select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).mapInArrow(_local, "u long, v long").distinct(), "edges")
    state = None
    while True:
        large = saved(_large_star(now), "edges")
        then = saved(_small_star(large).filter("u <> v").distinct(), "edges")
        forget(large)
        seen = then.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        forget(now)
        now = then
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select("v", "v").distinct())
