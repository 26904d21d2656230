"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for nodes with an edge.

    Rounds of large-star and small-star until nothing changes, a logarithmic
    number on all known graphs. A node with very many edges is split by AQE's
    skew handling in the joins; minima combine before they are shuffled. Each
    round's edges are a stored table.
    """
    now = store(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # large star: every larger neighbour of a node gets an edge to the node's smallest neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours get an edge to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = store(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    root = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return root.unionByName(root.select(F.col("component").alias("node"), "component").distinct())


class Union:
    """Disjoint sets of 0..n-1, the smallest member as root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.parent))], np.int64)
