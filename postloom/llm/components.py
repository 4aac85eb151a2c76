"""Connected components of a distributed edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.tables import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable, for each node that ``edges (a, b)`` names.

    Labels move along edges and then jump to the label of their label, so a path of length n takes
    about log n rounds. Each round is written out; only the number of changes reaches the driver. A
    hub's edges are pre-aggregated by ``min`` and its joins can be split. Null ends are ignored;
    without edges the result is empty.
    """
    both = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")
    )
    both = stored(both.select("e.a", "e.b").distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    labels = stored(labels.select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("component").alias("m"))
        )
        moved = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("old"), F.least("component", "m").alias("next")
        )
        # What a node's label has itself moved to in the last round lies in the same component.
        roots = labels.select(F.col("node").alias("root"), F.col("component").alias("further"))
        moved = moved.join(roots, F.col("next") == F.col("root"), "left").select(
            "node", "old", F.least("next", "further").alias("component")
        )
        moved = stored(moved, "labels")
        labels = moved.select("node", "component")
        if moved.filter("component <> old").isEmpty():
            return labels


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable for each of ``n`` indices, by links ``a[i]`` - ``b[i]``."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(label, nxt := label[label]):
            label = nxt
    return label
