"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameledger.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of these neighbours."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    joined = down.join(least, "a")
    moved = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the least node that can be reached.

    A node that many others point to is only ever the target of a group that counts or takes a minimum; the rounds
    grow with the logarithm of the longest chain. Each round is written to the shared folder.
    """
    links = written(links.where("a <> b").select("a", "b").distinct(), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    before = None
    while True:
        links = written(_small_star(_large_star(links)), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ends.unionByName(roots)
