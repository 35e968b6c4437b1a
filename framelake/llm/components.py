"""Connected components of links, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (columns a, b; any direction):
    ``label`` is the least node reachable.

    Alternates two steps that keep connectivity: every node hands its larger
    neighbours to its least one (large star), then its smaller ones (small
    star), until the links are stars around the least nodes.  Sums and joins
    are by node, with partial aggregation, so a node of very many links only
    contributes one row a task to the minimum."""
    edges = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while True:
        # large star: for u and each neighbour v > u, link v to the least of u and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = cut(both.join(cut(least, "least"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large-star")
        # small star: for u, link all its smaller neighbours and itself to the least of them
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        met = large.join(least, "a")
        small = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        small = cut(small, "small-star")
        left, right = edges.select(F.xxhash64("a", "b").alias("x")), small.select(F.xxhash64("a", "b").alias("x"))
        before, after = (d.agg(F.count("*").alias("n"), F.bit_xor("x").alias("x")).first() for d in (left, right))
        edges = small
        if before == after:
            break
    # stars: every node but the least points straight at it
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
