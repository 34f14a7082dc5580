"""Sorting, top-n and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BINS = 4096

def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The n rows with the largest ``by``; equal values are decided by the smaller ``tie``."""
    return df.orderBy(F.col(by).desc(), F.col(tie).asc()).limit(n)


def rank_by(df: DataFrame, **ranks: str) -> DataFrame:
    """Add rank columns, ``rank_by(df, profit_rank="total_profit")``; 1 is the largest, ties share a rank.

    A NULL ranks last. The columns are numbers. One lazy plan for every size:

    The values are cut into ``BINS`` bins of equal width on a logarithmic scale between the smallest and the
    largest. A rank is the number of rows in higher bins plus the rank inside the own bin, so rows are
    shuffled by bin and never sorted as a whole, and the place of a row is worked out beside it. Rows of a bin
    with one value only need no sorting; they are spread out, so a value that very many rows share meets in
    no task. The bins, which ``BINS`` bounds, are broadcast.
    """
    bins = {name: f"_bin{k}" for k, name in enumerate(ranks)}
    placed = _in_bins(df, {bins[name]: column for name, column in ranks.items()})
    out = placed
    for name, column in ranks.items():
        out = _with_rank(out, placed, df.columns, column, bins[name], name)
    return out.drop(*bins.values())


def rank_in_ranges(df: DataFrame, column: str, name: str) -> DataFrame:
    """``rank_by`` for one column."""
    return rank_by(df, **{name: column})


def _in_bins(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The bin of each value of some columns, by new name; -1 for a NULL."""
    scaled = {}
    for name, column in columns.items():
        value = F.col(column).cast("double")
        scaled[name] = F.signum(value) * F.log1p(F.abs(value))
    # One row for all columns, met once.
    ends = df.agg(F.struct(*[F.struct(F.min(v).alias("low"), F.max(v).alias("high")).alias(name)
                             for name, v in scaled.items()])).scalar()

    def place(name: str) -> Column:
        low, high = F.col(f"_ends.{name}.low"), F.col(f"_ends.{name}.high")
        share = F.floor(F.try_divide(scaled[name] - low, high - low) * BINS)
        return F.when(F.col(columns[name]).isNull(), F.lit(-1)).otherwise(
            F.least(F.coalesce(share, F.lit(0)), F.lit(BINS - 1)).cast("int"))

    return df.withColumn("_ends", ends).withColumns({name: place(name) for name in columns}).drop("_ends")


def _with_rank(rows: DataFrame, placed: DataFrame, row: list[str], column: str, bin: str, name: str) -> DataFrame:
    bins = placed.groupBy(bin).agg(
        F.count(F.lit(1)).alias("_size"), F.min(column).eqNullSafe(F.max(column)).alias("_single"))
    higher = W.orderBy(F.desc(bin)).rowsBetween(W.unboundedPreceding, -1)
    bins = bins.select(bin, "_single", F.coalesce(F.sum("_size").over(higher), F.lit(0)).alias("_above"))
    spread = F.when(F.col("_single"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in row]), F.lit(BINS)))
    inside = F.rank().over(W.partitionBy(bin, "_spread").orderBy(F.col(column).desc_nulls_last()))
    return rows.join(F.broadcast(bins), bin).withColumn("_spread", spread).select(
        *rows.columns, (F.col("_above") + inside).cast("bigint").alias(name))


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in the order of the keys; a leading minus, ``ordered(df, "-profit", "category")``, turns one round."""
    return df.orderBy(*[F.col(k[1:]).desc() if k.startswith("-") else F.col(k).asc() for k in keys])
