"""Connected components of a graph that may be larger than any machine.

Each round every node points to its smallest neighbour, pointers are followed to their roots by doubling,
and the edges are drawn again between roots. A round at least halves the nodes that still have edges, so
rounds, and the doublings in each, grow with the logarithm of the input. Tables are cut from their lineage with ``checkpoint``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b); the root is one node of the component. Loops are ignored; nulls aren't allowed."""
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint()
    rooted: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionAll(edges.select("b", "a"))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("q")).checkpoint()
        while True:  # pointers are followed twice as far each time, until all end at a root
            onward = up.select(F.col("v").alias("w"), F.col("q").alias("r"))
            up = up.join(onward, F.col("q") == F.col("w")).select("v", F.col("r").alias("q"), (F.col("q") != F.col("r")).alias("moved")).checkpoint()
            if up.where("moved").isEmpty():
                break
        if rooted is None:
            rooted = up.select(F.col("v").alias("node"), F.col("q").alias("root"))
        else:
            rooted = rooted.join(up, F.col("root") == F.col("v"), "left").select("node", F.coalesce("q", "root").alias("root")).checkpoint()
        left = up.select(F.col("v").alias("a"), F.col("q").alias("a2"))
        right = up.select(F.col("v").alias("b"), F.col("q").alias("b2"))
        drawn = edges.join(left, "a").join(right, "b").where("a2 <> b2")
        edges = drawn.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct().checkpoint()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if rooted is None else rooted
