"""Connected components of an edge table, by alternating large and small stars.

Every round is written to the shared folder, so lineage stays short and a lost executor costs a re-read. Only one-row facts
(is it done?) reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.session import written


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as (node, smallest node) pairs; for the edges that one task holds."""
    nodes, back = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = back[: len(u)], back[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for x in (a, b, root[a], root[b]):
            np.minimum.at(new, x, low)
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u, v) that is not itself its component's smallest node, the root."""
    now = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _done(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v")
        now = written(small.unionByName(least.withColumnRenamed("low", "v")).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _done(edges: DataFrame) -> bool:
    """Whether all edges go from a node with no other edge to one that is no such node."""
    several = edges.groupBy("u").count().where("count > 1").limit(1).count()
    return not several and not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
