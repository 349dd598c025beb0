"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """node, root for all nodes of ``links`` (a, b): equal roots mean connected.

    Each round hooks every node to the smallest of itself and its neighbours and contracts the
    links to those hooks, so their number falls geometrically when node numbers are random, as
    hashes are.  Rounds are written tables.
    """
    edges = staged(links.select("a", "b").where("a <> b").distinct())
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = staged(both.groupBy("a").agg(F.min("b").alias("up")).select(
            F.col("a").alias("node"), F.least("a", "up").alias("up")))
        if roots is None:
            roots = hooks.withColumnRenamed("up", "root")
        else:
            roots = staged(roots.join(hooks.withColumnRenamed("node", "root"), "root", "left")
                           .select("node", F.coalesce("up", "root").alias("root")))
        moved = (edges.join(hooks.select(F.col("node").alias("a"), F.col("up").alias("c")), "a")
                 .join(hooks.select(F.col("node").alias("b"), F.col("up").alias("d")), "b"))
        edges = staged(moved.where("c <> d").select(
            F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct())
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
