"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut, discard


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): each vertex of an edge with the smallest id it can reach.

    A round gives each vertex the least label among its own, its neighbours' and
    that label's own label, so a chain of n vertices needs about log n rounds.
    Each round's labels are written to the shared folder, and those before
    removed; only a count reaches the driver. Edges with a null end are ignored.
    """
    pairs = edges.select(F.col(a).alias("s"), F.col(b).alias("t")).where("s IS NOT NULL AND t IS NOT NULL")
    links = cut(pairs.union(pairs.select(F.col("t").alias("s"), F.col("s").alias("t"))).distinct())
    labels = cut(links.groupBy(F.col("s").alias("id")).agg(F.least(F.min("t"), F.first("s")).alias("c"), F.lit(True).alias("moved")))
    while True:
        own, theirs = labels.select("id", "c"), labels.select(F.col("id").alias("j"), F.col("c").alias("jc"))
        near = links.join(theirs, F.col("t") == F.col("j")).groupBy("s").agg(F.min("jc").alias("n"))
        lower = own.join(near, F.col("id") == F.col("s"), "left").select("id", "c", F.least("c", F.coalesce("n", "c")).alias("m"))
        jumped = lower.join(theirs, F.col("m") == F.col("j"), "left").select("id", F.least("m", F.coalesce("jc", "m")).alias("d"), "c")
        new = cut(jumped.select("id", F.col("d").alias("c"), (F.col("d") != F.col("c")).alias("moved")))
        discard(labels)
        labels = new
        if labels.where("moved").isEmpty():
            return labels.select("id", F.col("c").alias("component"))


def merged(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, a, b): the parts of links u - v joined under their least label, and the pairs of labels that were joined."""
    n, a, b = len(label), [], []
    while True:
        x, y = label[u], label[v]
        apart = x != y
        if not apart.any():
            return label, np.concatenate([*a, u[:0]]), np.concatenate([*b, u[:0]])
        u, v = u[apart], v[apart]
        parent = np.arange(n)
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        hooked = np.flatnonzero(parent != np.arange(n))
        a.append(hooked)
        b.append(parent[hooked])
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]
