"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.sources.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)``: each node that is not the smallest of its component, and the smallest.

    ``edges`` holds pairs of longs ``u, v`` in any direction; loops and repeated rows do no harm. Every
    round is written, so lost executors cost a round at most. Minima are merged before each shuffle.
    """
    links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = materialize(links.where("u > v").distinct(), "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        links = materialize(small, "small_star")
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return links
        before = mark
