"""Connected components of an edge table: union-find inside each partition, then stars across partitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filefeatures.session import stage


def union_find(left: np.ndarray, right: np.ndarray) -> dict[int, int]:
    """Smallest node reachable, for every node of the edges."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in list(parent)}


def _local(batches):
    """A spanning forest of each batch, as edges from a node to the smallest one of its tree."""
    for batch in batches:
        if batch.num_rows:
            found = union_find(batch.column("a").to_numpy(), batch.column("b").to_numpy())
            found = {node: top for node, top in found.items() if node != top}
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())], names=["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node (a > b in every edge) and its smaller neighbours are tied to the smallest of these."""
    least = stage(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that an edge (a, b) of longs touches; the component is its smallest node.

    Loops and repeated edges change nothing; no edges give no rows. Every round is a pre-aggregated minimum and a join with
    one row per node. The minima are written first, so that nothing but the shuffles lies below the join and adaptive
    execution can split the edges of a hub over several tasks: neither a component nor a node's neighbourhood has to fit
    into one.
    """
    now = stage(edges.where("a <> b").mapInArrow(_local, "a long, b long"), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        now = stage(_small_star(_large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
