"""Connected components as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderfield.scratch import settle


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) of every node with an edge in ``edges`` (a, b); the component is its smallest node.

    Alternating large and small stars: each round hangs larger neighbours, then
    all smaller ones, on a node's smallest neighbour. Every round's edges are
    written once; nothing but their count and checksum reaches the driver.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    links = settle(edges.where(F.col("a") != F.col("b")).select(high, low).distinct(), "links")
    before = None
    while (now := links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()) != before:
        before = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = settle(hung.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
