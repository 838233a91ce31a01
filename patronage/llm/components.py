"""Connected components of a link table, by alternating large and small stars.

A round joins every node to the smallest node next to it, first among the
larger neighbours, then among the smaller ones; the links shrink to stars
around each component's smallest node in O(log^2 n) rounds.  Minima are
aggregates with map-side combine and joins are plain equi-joins, so the hub of
a large group is split by adaptive execution and no neighbour list is ever
collected.  Each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """(a, b) with a > b -> each larger neighbour of a node joined to the node's minimum."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = _smallest(both).select("a", F.least("m", "a").alias("m"))
    up = links.select(F.col("b").alias("a"), F.col("a").alias("b"))  # b > a
    return up.join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """(a, b) with a > b -> a and its smaller neighbours joined to the least of them."""
    joined = links.join(_smallest(links), "a")
    return (joined.select(F.explode(F.array(
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
        F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("x"))
        .select("x.a", "x.b").where("a <> b").distinct())


def components(links: DataFrame) -> DataFrame:
    """(a, b) rows of any orientation -> (node, root) for every node with a link,
    roots included; root is the smallest node of the component."""
    links = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "links")
    before = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            break
        before = now
        links = materialize(_small_star(_large_star(links)), "links")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
