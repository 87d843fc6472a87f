"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostscope.llm.common import written


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (u, v), u > v: links the larger (or else the smaller) neighbours of each node to its least one."""
    if larger:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("_m"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v")).unionByName(least.select("u", F.col("_m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(ref, root) for every node of links (a, b): root is the least node of its component.

    Each step is two joins whose hot keys Spark can split; steps are written to the shared folder and number about the
    square of the logarithm of the longest path at most.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    print_of = F.struct(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)))
    seen = edges.agg(print_of).first()[0]
    while True:
        edges = written(_star(_star(edges, True), False), "stars")
        now = edges.agg(print_of).first()[0]
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("ref"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("ref"), F.col("v").alias("root")).distinct())
