"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node that has a link; the label is the component's least node.

    ``links`` has longs ``a`` and ``b``, in any direction and with repetitions.
    Alternating large-star and small-star steps: each sends a node's neighbours
    to the least of them, until nothing changes. A node of many links is summed
    before the shuffle, and its rows are split by AQE's skew join.
    """
    edges = stored(_distinct(links.select("a", "b").where("a <> b")), "links")
    seen = None
    while True:
        # large star: neighbours greater than the node go to the least neighbour
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = stored(_distinct(large), "large-star")
        # small star: smaller neighbours and the node itself go to the least one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = stored(_distinct(small.select("e.*").where("a <> b")), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _distinct(links: DataFrame) -> DataFrame:
    """Each link once, from the greater node to the smaller."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
