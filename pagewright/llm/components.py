"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.shared import stash, unstash


def _print_of(edges: DataFrame) -> tuple:
    """Count and order-free hashes of a link table, to see when it no longer changes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1))), F.sum("a"), F.sum("b")).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a long, b long); the component is its smallest node.

    Alternates large-star and small-star steps (each node points its larger, then its smaller
    neighbours at the smallest one) until the links are stars; every step is an aggregation
    and a join on the node, and its result is written to the shared folder, so no lineage
    builds up.  Hot nodes are no problem: a star's centre is only ever aggregated by minimum.
    Self-links and repeated links are allowed; an empty table gives no rows.
    """
    edges = stash(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while True:
        # large star: every neighbour larger than the node is linked to the smallest of its neighbourhood
        both = edges.union(edges.select("b", "a")).toDF("node", "other")
        least = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = both.where("other > node").join(least, "node").select(F.col("least").alias("a"), F.col("other").alias("b")).distinct()
        # small star: the node and its smaller neighbours are linked to the smallest
        large = stash(large, "large-star")
        least = large.groupBy("b").agg(F.min("a").alias("least"))
        small = large.join(least, "b")
        small = small.select(F.col("least").alias("l"), F.explode(F.array("a", "b")).alias("n")).where("l <> n").distinct().toDF("a", "b")
        after = stash(small, "small-star")
        done = _print_of(after) == _print_of(edges)
        unstash(edges, large)
        edges = after
        if done:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select("a", "a").distinct())
