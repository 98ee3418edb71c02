"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


#: Links whose stars' centres are broadcast; beyond it they meet in a join.
BROADCAST_LINKS = 250_000


def _centred(edges: DataFrame, least: DataFrame, few: bool) -> DataFrame:
    """The links with the least node of each star. Few stars are broadcast, so a star of most links isn't one task's; where there are many,
    the join is split by adaptive execution."""
    return edges.join(F.broadcast(least) if few else least, "a")


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _centred(both.where(F.col("b") > F.col("a")), least, few).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return _centred(down, least, few).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, space: Workspace, name: str) -> DataFrame:
    """node, root (the least node of its component) for every node with a link. ``edges`` has long columns a and b.

    Each round is written to the shared folder. Stars aggregate before they shuffle, so a node with very many links
    costs a row for each link and never a group in memory."""
    edges = space.save(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), f"{name}-0")
    state, k, n = None, 0, edges.count()
    while True:
        k += 1
        few = n <= BROADCAST_LINKS  # a star round makes no more links than it has
        edges = space.save(_small_star(_large_star(edges, few), few).where(F.col("a") != F.col("b")).distinct(), f"{name}-{k}")
        space.drop(f"{name}-{k - 1}")
        r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(r) == state:
            break
        state, n = tuple(r), r[0]
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
