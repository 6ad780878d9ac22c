"""Connected components of a table of links, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stage


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``links(a, b)``: rows ``(node, component)``, each linked node once.

    Large-star and small-star rounds: every node hangs its larger neighbours, then its smaller ones, on the
    smallest neighbour it knows, until nothing changes. Nulls and loops are ignored. Each round is written to
    the shared folder; nothing but a checksum goes to the driver. A hub's rows are pre-aggregated on the way
    to its minimum and split by the skew join on the way back.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stage(edges.filter("a is not null and b is not null and a <> b").distinct(), "links")
    before = _checksum(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # All links now point from a larger node (a) to a smaller one (b).
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stage(small.union(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
