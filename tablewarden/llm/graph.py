"""Connected components of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.session import materialize

ROWS_PER_TASK = 100_000


def _above(parents: DataFrame) -> DataFrame:
    """(node, up) with every ``up`` replaced by the node above it."""
    above = parents.select(F.col("node").alias("__node"), F.col("up").alias("__up"))
    return parents.join(above, F.col("up") == F.col("__node"), "left").select("node", F.coalesce("__up", "up").alias("up"))


def _roots(parents: DataFrame, tasks: int) -> DataFrame:
    """(node, up) with every ``up`` replaced by the root above it; doubling, so depth costs its logarithm."""
    while True:
        once = _above(parents)
        above = once.select(F.col("node").alias("__node"), F.col("up").alias("__up"))
        stepped = materialize(
            once.join(above, F.col("up") == F.col("__node"), "left").select(
                "node", F.coalesce("__up", "up").alias("up"), (F.coalesce("__up", "up") != F.col("up")).alias("moved")).coalesce(tasks),
            "roots",
        )
        parents = stepped.select("node", "up")
        if stepped.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """Columns ``a b`` to ``node component`` (the smallest node reachable); nodes without links are absent.

    Each turn hangs every node below its smallest neighbour, follows those arrows to their roots and joins
    each tree to one node. At least half of the nodes that still have links vanish in a turn. Link rows of
    a node with many links are combined before they are shuffled; nothing is collected. The number of tasks
    that write a table follows the number of links, so that the many short turns of a small graph stay short.
    """
    tasks = links.count() // ROWS_PER_TASK + 1
    edges = materialize(links.select("a", "b").where("a != b").distinct().coalesce(tasks), "links")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    first = True
    while left := edges.count():
        tasks = left // ROWS_PER_TASK + 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("up"))
        roots = _roots(parents, tasks)
        up = roots.select(F.col("node").alias("__node"), F.col("up").alias("__up"))
        # Every node has a link in the first turn; later turns join the roots of earlier ones.
        labels = roots.withColumnRenamed("up", "component") if first else labels.join(
            up, F.col("component") == F.col("__node"), "left").select("node", F.coalesce("__up", "component").alias("component"))
        first = False
        moved = edges.join(up, F.col("a") == F.col("__node")).select(F.col("__up").alias("a"), "b")
        moved = moved.join(up, F.col("b") == F.col("__node")).select("a", F.col("__up").alias("b"))
        edges = materialize(moved.where("a != b").distinct().coalesce(tasks), "links")
    return materialize(labels, "labels")
