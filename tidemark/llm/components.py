"""Connected components of an edge table by repeated contraction.

Each round hangs every node on its smallest neighbour, follows that once or twice and replaces the edges by those between
what is left. Only nodes without a smaller neighbour stay, at most half of them, so the rounds grow with the logarithm
of the nodes. Minima are grouped with partial results and lookups are joins that Spark can split, so a node with very
many edges does not meet in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import saved


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, component): the smallest node reachable, for every node that has an edge."""
    left = saved(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        up = saved(up.select("node", F.least("node", "up").alias("up")), "hung")
        for _ in range(2):
            over = up.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
            up = up.join(over, F.col("up") == F.col("_n")).select("node", F.col("_u").alias("up"))
        up = saved(up, "hung")
        of_a = up.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        of_b = up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        left = left.join(of_a, "a").join(of_b, "b").filter("ua <> ub").select(F.col("ua").alias("a"), F.col("ub").alias("b"))
        left = saved(left.distinct(), "edges")
        if labels is None:
            labels = up.withColumnRenamed("up", "component")
        else:
            labels = labels.join(up, F.col("component") == up["node"], "left").select(
                labels["node"], F.coalesce("up", "component").alias("component")
            )
        labels = saved(labels, "components")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return labels


def joined(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable over the links a-b, for every index."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
