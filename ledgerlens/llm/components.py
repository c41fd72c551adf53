"""Connected components of an edge table by alternating star contraction.

Large-star hooks every larger neighbour of a node to the node's smallest neighbour,
small-star does so for the smaller ones; both keep connectivity, and the graph turns into
stars around each component's smallest node in a logarithmic number of rounds. A round is
two grouped minima and two joins on the edges alone; each round is written to the shared
checkpoint folder, and only one count comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hooked = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # u > v in every edge: v runs over the smaller neighbours of u.
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        hooked = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return hooked.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) of every node that has an edge.

    ``edges``: two columns of one orderable type; direction, repeats and loops don't matter;
    edges with a NULL end are no edges.
    """
    a, b = edges.columns[:2]
    now = (edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    now = stored(now, "edges")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    mark = None
    while True:
        now = stored(_star(_star(now, True), False), "stars")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark is not None and tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
