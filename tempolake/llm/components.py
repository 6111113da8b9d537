"""Connected components of links, in numpy for one block and in Spark for all."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempolake.llm import scratch


def merge_labels(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the classes of ``left[i]`` and ``right[i]`` in ``labels``, in place.

    ``labels[v]`` is the smallest member of v's class, before and after.
    """
    while len(left):
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return
        left, right = left[apart], right[apart]
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(labels, high, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels[:] = jumped


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every id in ``links`` (a long, b long); the smallest id names it.

    Alternates between linking the larger and the smaller neighbours of each id to its smallest
    neighbour until nothing changes. Each step is a grouped minimum with map-side combination
    and a join; no neighbourhood is collected, and every step is written to the shared folder.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Edges (u, v), u > v, each to the smallest neighbour of one end."""
        if large:
            near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            near = edges
        low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = near.join(low, "u")
        if large:
            pairs = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            pairs = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        return pairs.filter("u > v").distinct()

    def state(edges: DataFrame) -> tuple:
        mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = scratch.written(edges.filter("u > v").distinct(), "links")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = scratch.written(star(star(edges, True), False), "components")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(roots)
