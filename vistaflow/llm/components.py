"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaflow.session import staged

MAX_ROUNDS = 60


def _smallest_neighbour(links: DataFrame) -> DataFrame:
    """Links with the smallest node of each node's neighbourhood, the node included."""
    smallest = links.groupBy("a").agg(F.min("b").alias("_low"))
    smallest = smallest.select("a", F.least("a", "_low").alias("low"))
    return links.join(smallest, "a")


def _unsettled(pairs: DataFrame) -> int:
    """Nodes that hang on several nodes, or on one that itself hangs on another."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(
        pairs.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up > 1 OR (up = 1 AND down = 1)").count()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b); the root is the smallest node.

    Every round hangs each node's larger neighbours, then its smaller ones, on the smallest
    (Kiveris et al. 2014), which takes about log n rounds for any shape, and none for links
    that are stars already. Nothing but a count comes to the driver; each round is a table in
    the shared folder, so a lost executor costs a task. The minimum of a node is joined back
    plainly; where a node has very many links, adaptive execution splits its partition.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = staged(pairs.distinct(), "links")
    for _ in range(MAX_ROUNDS):
        if not _unsettled(pairs):
            break
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _smallest_neighbour(both).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        hung = _smallest_neighbour(large)
        small = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            hung.select("a", F.col("low").alias("b")))
        pairs = staged(small.filter("a <> b").distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
