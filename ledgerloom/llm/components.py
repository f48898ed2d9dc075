"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialise


def _least(links: DataFrame) -> DataFrame:
    # written down, so that the join with it deals both sides anew and may split a hub's partition
    return materialise(links.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m")), "least")


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour to its larger ones."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    out = both.join(_least(both), "u").filter(F.col("v") > F.col("u"))
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour to its smaller ones; links run from large to small."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in links (u, v): the smallest node that each is connected to.

    Each round's links are written to the shared folder. A hub's links are only ever aggregated with
    partial sums or joined, so a join that splits skewed partitions spreads them. Nodes without links,
    and links of a node to itself, give no row.
    """
    down = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current, mark = materialise(down.distinct(), "links"), None
    while True:
        current = materialise(_small_star(_large_star(current).distinct()), "links")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
