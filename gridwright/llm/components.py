"""Connected components of a graph given by its edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the least node of its component.

    Each round connects the larger neighbours of a node, then its smaller ones, to the least of them. A node with many
    neighbours is never gathered: its least neighbour is an aggregate, joined back to the edges. The number of rounds
    grows with the logarithm of the longest chain, and every round ends in a written table.
    """
    links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    links = written(links, "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        after = written(small.filter("u <> v").distinct(), "links")
        if after.count() == links.count() and after.exceptAll(links).isEmpty():
            break
        links = after
    return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
