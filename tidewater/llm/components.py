"""Connected components of a link table by alternating large-star and small-star steps.

Both steps only need the minimum of each node's neighbourhood, which is a
partially aggregated group-by, and a join back to the links, whose skewed keys
Spark splits at run time.  No neighbourhood is ever gathered in one task.
Before the first step every task replaces the links it holds by a spanning
forest, so a dense group sends at most one link per node and task onward.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star-shaped spanning forest (node, smallest node of its component) of links."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[root]
        if np.array_equal(new, root):
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _forest_batches(batches):
    for batch in batches:
        u, v = forest(np.asarray(batch.column(0)), np.asarray(batch.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (u long, v long).

    component is the smallest node reachable.  Nodes without a link to another
    node do not appear; empty input gives an empty result; repeated links, loops
    and both directions are harmless; null ends are ignored.
    """
    two = links.where("u is not null and v is not null and u != v").select(
        F.col("u").cast("long"), F.col("v").cast("long"))
    edges = save(two.mapInArrow(_forest_batches, "u long, v long").distinct(), "cc-links")
    before = None
    for _ in range(max_rounds):
        state = edges.agg(F.count(F.lit(1)).alias("n"),
                              F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if state == before:
            break
        before = state
        if not state["n"]:
            break
        edges = save(_small_star(_large_star(edges)), "cc-round")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    hang = (down.join(low, "u").where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return hang.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
