"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import stored


def components(links: DataFrame) -> DataFrame:
    """``links`` has long columns ``a`` and ``b``; returns ``node`` and ``component``, the
    smallest node that it reaches, for every node with a link.

    Each round keeps as many edges as there are at most, aggregates minima with map-side
    combine and joins them back, so a hub's rows can be split by the skewed join.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = None
    while (state := edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40)))).first()) != seen:
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        ).distinct()
        edges = stored(small, "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
