"""Connected components of links by alternating star contractions, all in joins and grouped minima.

Each round sends every node's neighbours to the smallest node it knows (large star: those larger than the node; small
star: those not larger).  The links stay connected as they were and end as stars around each component's smallest node.
In all links a > b.  Each star's minima and links are written to the shared folder, so that lineage stays short and plans stay
small: the driver holds some copies of a plan, and plans anew behind each of its stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._tables import dealt_join, stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("v"), F.count_if(F.col("v") > F.col("u")).alias("n")).where("n > 0")
    least = stored(least.select(F.col("u").alias("b"), "n", F.least("u", "v").alias("m")))
    # a hub's neighbours are many rows of one key
    return stored(dealt_join(links, least, ["b"]).select("a", F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = stored(links.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
    moved = dealt_join(links, least.where("n > 1"), ["a"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stored(moved.union(least.select("a", F.col("m").alias("b"))).distinct())


def min_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its component's smallest node) for every node in ``links`` (columns a, b of one type)."""
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        figures = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"), F.countDistinct("a").alias("u")).first()
        hubs = links.select("b").distinct().join(links.select("a").distinct(), F.col("b") == F.col("a"), "left_semi")
        if figures["n"] == figures["u"] and hubs.isEmpty():  # each node has one link, to a node without any: stars
            break
        if figures == before:
            raise RuntimeError("the contraction of links stands still")
        before = figures
        links = _small_star(_large_star(links))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(links.select("b", "b").distinct())
