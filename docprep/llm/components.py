"""Connected components of links between records, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docprep.session import cut


def _toward_least(both: DataFrame) -> DataFrame:
    """(u, v, m): each edge in both directions with the least node of u's neighbourhood, u included."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its least node.

    Edges stay distributed; a round costs two aggregations and two joins on the node, and the rounds grow as the
    logarithm of the longest chain. Each round's edges are checkpointed. Null ends and loops are ignored.
    """
    edges = edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u <> v").distinct()
    edges = cut(edges)
    mark = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = cut(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
