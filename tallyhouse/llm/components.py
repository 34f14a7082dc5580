"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text import stored


def _stars(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Link neighbours to the smallest of each node's neighbourhood.

    With ``both_ways``, a node's larger neighbours move to the smallest node around; else the node and its
    smaller neighbours do.
    """
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else edges
    least = around.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    joined = around.join(least, "u")
    if both_ways:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            least.select("u", F.col("least").alias("v")))
    return moved.filter("u > v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row per linked node: ``node`` and ``root``, the smallest node that it reaches.

    Links go either way; loops, repeated links and those with a null end are ignored. Each round makes two
    passes over the links, which are never more than were given, and is written to the shared folder; the
    number of rounds grows with the logarithm of the longest chain. Only a count and a checksum of the
    links come to the driver.
    """
    links = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = links.agg(mark).first()[0]
    while True:
        links = stored(_stars(_stars(links, True), False), "links")
        now = links.agg(mark).first()[0]
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
