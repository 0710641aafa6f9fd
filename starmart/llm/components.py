"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import ensure_checkpoint_dir


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, parent), by following parents twice as far each time."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        further = parents.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), (F.col("above") != F.col("parent")).alias("moved"))
        further = further.checkpoint()
        parents = further.select("node", "parent")
        if further.where("moved").isEmpty():
            return parents.withColumnRenamed("parent", "root")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Every node is hooked to its smallest neighbour, what hangs together is
    contracted, and links between different groups are kept for the next
    round.  Both the hooking and the contracting group by node with partial
    sums or join a table that is unique by node, so a node of very many links
    is split.  Tables between rounds are checkpointed in the shared folder.
    Null ends are ignored; an empty table has no components.
    """
    ensure_checkpoint_dir(links.sparkSession)
    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = ends.where("a < b").distinct().checkpoint()
    labels = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        roots = _roots(hooked.select("node", F.least("node", "least").alias("parent")))
        if labels is None:
            labels = roots.select("node", F.col("root").alias("component"))
        else:
            above = roots.select(F.col("node").alias("component"), "root")
            labels = labels.join(above, "component", "left").select("node", F.coalesce("root", "component").alias("component")).checkpoint()
        first = roots.select(F.col("node").alias("a"), F.col("root").alias("x"))
        second = roots.select(F.col("node").alias("b"), F.col("root").alias("y"))
        moved = edges.join(first, "a").join(second, "b").where("x <> y")
        edges = moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().checkpoint()
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
