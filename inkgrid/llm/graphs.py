"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """links: a, b long. A row for each node that isn't the smallest of its component: node, component (the smallest).

    Each round links every node's larger neighbours to its smallest one, then its smaller ones; after a number of
    rounds that grows with the logarithm of the longest path, only stars are left. Minima are taken before the
    exchange, so a node with very many links is no heavier than others.
    """
    edges = links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v").distinct()
    before = None
    while True:
        edges = common.cut(edges)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
        before = now
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("m").alias("u"), F.col("y").alias("v")).where("u < v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").where("u > m").select(F.col("m").alias("u"), F.col("u").alias("v"))
        edges = small.union(low.select(F.col("m").alias("u"), "v")).distinct()
