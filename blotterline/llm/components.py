"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotterline.llm.common import materialize


def _with_least(edges: DataFrame) -> DataFrame:
    """Each directed edge with the least of its start and all neighbours of the start."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least.select("u", F.least("u", "least").alias("least")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_least(both).where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down)
    moved = linked.select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = linked.select("u", F.col("least").alias("v"))
    return moved.unionAll(own).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and the least node of its component, for all nodes of ``edges`` (u, v), both longs.

    Rounds of large and small stars, each stored, until the edges do not change: then every node
    points at the least node of its component. A logarithmic number of rounds, each with
    groupings by node that combine before the shuffle; Spark splits the join of a node with very
    many neighbours. Repeated edges and loops do no harm; no edges give no rows.
    """
    clean = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = materialize(clean.distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
        now = materialize(_small_star(_large_star(now)), "edges")


def connect(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (every entry a root) after joining the sets of ``a`` and ``b``, element by element."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            break
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = parent[parent]
            if np.array_equal(above, parent):
                break
            parent = above
    return parent
