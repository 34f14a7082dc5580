"""A join that deals out the rows of heavy keys by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_keys(facts: DataFrame, key: str, parts: int) -> DataFrame:
    """Keys that hold more than one in ``parts`` rows, with the number of slices that brings them to that size.

    At most ``parts`` rows. Counts are reduced before the shuffle, and a null key is none.
    """
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") * parts > total).select(
        F.col(key).alias("_heavy"), F.ceil(F.col("_n") * parts / total).cast("int").alias("_slices"))


def spread_join(facts: DataFrame, dimension: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Inner join on ``key`` in which no key meets in one task.

    Rows of a heavy key are cut into slices by a hash of the whole row, and its rows of the dimension are
    repeated for every slice. ``parts`` is the number of equal parts that one slice should not exceed, by
    default that of shuffle partitions. It costs one count of the keys; adaptive execution also splits
    partitions, but only by size and only where the join itself made the shuffle.
    """
    parts = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(facts, key, parts))
    slices = F.coalesce("_slices", F.lit(1))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns])
    left = facts.join(heavy, facts[key] == F.col("_heavy"), "left").select(
        *[facts[c] for c in facts.columns], F.pmod(row, slices).cast("int").alias("_slice"))
    right = dimension.join(heavy, dimension[key] == F.col("_heavy"), "left").select(
        *[dimension[c] for c in dimension.columns], F.explode(F.sequence(F.lit(0), slices - 1)).alias("_slice"))
    return left.join(right, [key, "_slice"]).drop("_slice")
