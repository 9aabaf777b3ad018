"""Connected components of an edge table, without ever gathering it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch

_EDGE = "u bigint, v bigint"


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component, for nodes 0..n-1 and edges a-b (union-find on whole arrays)."""
    parent = np.arange(n)
    while len(a):
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        keep = low != high
        if not keep.any():
            break
        a, b, low, high = a[keep], b[keep], low[keep], high[keep]
        np.minimum.at(parent, high, low)
        while True:  # path halving for all nodes at once
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def _forest(batches):
    """Replaces the edges of a task by one edge from each node to its component's smallest node."""
    import pyarrow as pa

    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    u = np.concatenate([b.column(0).to_numpy() for b in tables])
    v = np.concatenate([b.column(1).to_numpy() for b in tables])
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = nodes[roots(len(nodes), index[: len(u)], index[len(u):])]
    own = nodes != root
    yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(root[own])], names=["u", "v"])


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``u, v`` (any two long columns) -> ``node, component``: the smallest node reachable.

    Nodes without an edge to another node are not listed.  Each round joins
    every node's neighbours to the smallest of them (large star), then every
    node's smaller neighbours likewise (small star); rounds shrink the graph
    to stars in about log(nodes) steps.  Before each round a task contracts
    the edges it holds by union-find.
    """
    a, b = edges.columns
    now = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
           .filter("u IS NOT NULL AND v IS NOT NULL AND u != v"))
    last = None
    held: DataFrame | None = None
    while True:
        local = now.repartition("u").mapInArrow(_forest, _EDGE)
        both = local.union(local.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.save(large, "large")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(smallest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(smallest)).distinct()
        small = scratch.save(small, "small")
        scratch.drop(large)
        if held is not None:
            scratch.drop(held)
        held = now = small
        sign = small.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).head()
        if (sign["n"], sign["s"]) == last or sign["n"] == 0:
            return small.select(F.col("u").alias("node"), F.col("v").alias("component"))
        last = (sign["n"], sign["s"])
