"""Connected components of a graph given by its edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.store import land


def connected(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (bigint columns x, y); root is
    the least node reachable.

    Alternates two steps until nothing changes: every node hands its least
    neighbour to its larger neighbours, then to its smaller ones.  Each round
    is written to the shared folder, and only a count and a checksum of the
    edges come to the driver.  A node with very many neighbours is a skewed
    join key, which adaptive execution splits.
    """
    now = land(edges.where(F.col("x") != F.col("y")).select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), name, ids=True)
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")).alias("h")).head()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        larger = both.join(least, "x").where(F.col("y") > F.col("x")).select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        least = larger.groupBy("x").agg(F.min("y").alias("m"))
        smaller = larger.join(least, "x").select(F.explode(F.array(F.struct("x", F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e"))
        now = land(smaller.select("e.*").where(F.col("x") != F.col("y")).distinct(), name, ids=True)
    roots = now.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct()
    return now.select(F.col("x").alias("node"), F.col("y").alias("root")).unionByName(roots)


def forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges with the same components: each node to the least of its
    component, for the edges that one task holds."""
    if not len(x):
        return x, y
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    a, b = at[:len(x)], at[len(x):]
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        np.minimum.at(new, label[a], label[b])      # hook the roots, too
        np.minimum.at(new, label[b], label[a])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    some = label != np.arange(len(nodes))
    return nodes[some], nodes[label[some]]
