"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from farebox.llm.shared import Scratch


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one edge per node with the same components: (node, smallest node)."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        live = label[a] != label[b]
        a, b = a[live], b[live]
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, label)``: the smallest node reachable, for each node with an edge.

    ``edges`` has columns u and v of one type. Alternates large and small stars:
    each round replaces a node's edges by edges to its smallest neighbour, so
    paths shorten by half or so and the edges end as one star per component.
    Minima are aggregated before the shuffle and joined back, so a node with
    very many edges is never gathered; Spark may split it in the join.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs, before, k = scratch.write(pairs, "edges-0"), None, 0
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label")).union(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        before, k = tuple(state), k + 1
        both = pairs.union(pairs.select("v", "u"))
        large = _to_smallest(both, scratch, f"low-{k}").where("far > u")
        large = scratch.write(large.select(F.col("far").alias("u"), F.col("low").alias("v")).distinct(), f"large-{k}")
        small = _to_smallest(large, scratch, f"lower-{k}")
        moved = small.where("far <> low").select(F.col("far").alias("u"), F.col("low").alias("v"))
        pairs = scratch.write(moved.union(small.select("u", F.col("low").alias("v"))).distinct(), f"edges-{k}")
        scratch.drop(f"edges-{k - 1}", f"large-{k}", f"low-{k}", f"lower-{k}")


def _to_smallest(directed: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Each edge (u, far) with the smallest of u and its neighbours.

    The minima are written first: then both sides of the join are plain
    exchanges, whose large partitions Spark can split.
    """
    lows = scratch.write(directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), name)
    return directed.select("u", F.col("v").alias("far")).join(lows, "u")
