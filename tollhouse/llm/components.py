"""Connected components by alternating large-star and small-star steps over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollhouse.llm.common import stored


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a, b) with a > b."""
    least = links.union(links.select("b", "a")).groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("m", "a").alias("m"))
    # large star: neighbours above a node hang on the least of its neighbourhood
    large = links.join(least, "b").select("a", F.col("m").alias("b")).where("a != b")
    # small star: a node and its neighbours below hang on the least of them
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
    return small.where("a != b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether the links are stars: no node hangs on two, or on one that hangs itself."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up > 0 AND down > 0").isEmpty()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): each node that has a link, with the smallest node it can reach. Nodes are of any type with an order.

    Links may come in either direction and repeatedly; a link of a node with itself, or with a null end, counts for
    nothing, and no links give no rows. The rounds grow with the logarithm of the longest path. Each round is stored, so
    lineage stays short; only whether it was the last comes to the driver.
    """
    a, b = F.col(left), F.col(right)
    links = stored(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    while not _settled(links):
        links = stored(_stars(links))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b").distinct())
