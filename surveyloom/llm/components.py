"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.session import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Smallest node that each node of ``edges`` (u, v: long) reaches: (node, component).

    Every round joins all larger neighbours of a node to the smallest one, then does the same for the smaller
    neighbours; the number of rounds grows with the logarithm of the longest path. Nodes without an edge, self loops
    and nulls are left out. A node with many neighbours is only ever aggregated or split by the skew join.
    """
    links = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while (now := _signature(links)) != before:
        before = now
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        links = stored(small, "links")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
