"""Connected components of a link table, by contraction.

In each round every node points to its smallest neighbour, pointers are
shortened until they end, and the links between what is left are drawn again.
Each round at least halves the nodes that still have links. Only minima and
joins are used, so no task holds the links of a node. Every step is a stored
table: nothing is recomputed when an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import stage


def _roots(links: DataFrame) -> DataFrame:
    """(node, root): the node that the pointers from each node lead to."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pointers = both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("root")
    )
    pointers = stage(pointers, "pointers")
    while True:
        onward = pointers.select(F.col("node").alias("from"), F.col("root").alias("onto")).where("from != onto")
        longer = pointers.join(onward, F.col("root") == F.col("from"), "left")
        pointers = stage(longer.select("node", F.coalesce("onto", "root").alias("root"), F.col("onto").isNotNull().alias("moved")), "pointers")
        if pointers.where("moved").limit(1).count() == 0:
            return pointers.select("node", "root")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b); the root is the smallest node that it reaches.

    Links may repeat, lead back, or lead from a node to itself; a node whose
    only link is to itself is left out, as are links with a null end.
    """
    links = stage(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while links.limit(1).count():
        roots = _roots(links)
        if found is None:
            found = roots
        else:
            step = roots.select(F.col("node").alias("from"), F.col("root").alias("onto"))
            found = stage(found.join(step, F.col("root") == F.col("from"), "left").select("node", F.coalesce("onto", "root").alias("root")), "roots")
        ends = roots.withColumnsRenamed({"node": "x", "root": "y"})
        drawn = links.join(ends, F.col("a") == F.col("x")).select(F.col("y").alias("a"), "b")
        drawn = drawn.join(ends, F.col("b") == F.col("x")).select("a", F.col("y").alias("b")).where("a != b")
        links = stage(drawn.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
