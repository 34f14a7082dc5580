"""Data-quality checks. Each returns a frame, so a check is a query like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyhouse.functions import line_profit, line_revenue, money
from tallyhouse.functions.amounts import line_cost


def violations(df: DataFrame, broken: Column) -> DataFrame:
    """Number of rows for which the condition holds; 0 is good."""
    return df.agg(F.count_if(broken).alias("bad_rows"))


def no_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Number of rows that hold a value that should have been removed."""
    return violations(df, F.col(column).isin(*values))


def computed_violations(sales: DataFrame) -> DataFrame:
    """Lines whose stored revenue or profit is not what quantity, price and cost say, to the cent."""
    return violations(
        sales,
        (money(F.col("line_revenue")) != money(line_revenue()))
        | (money(F.col("line_profit")) != money(line_profit())),
    )


def row_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of two frames that should have the same number of rows."""
    return (
        left.agg(F.count("*").alias("actual_rows"))
        .withColumn("expected_rows", right.agg(F.count("*")).scalar())
        .withColumn("same", F.col("actual_rows") == F.col("expected_rows"))
    )


def reconcile(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """Difference per key between two aggregates that should agree.

    A full outer join, so that a key lost on either side shows up instead of vanishing.
    """
    a = left.select(key, F.col(column).alias("left_value"))
    b = right.select(key, F.col(column).alias("right_value"))
    gap = F.coalesce("left_value", F.lit(0)) - F.coalesce("right_value", F.lit(0))
    return a.join(b, key, "full_outer").withColumn("difference", money(gap))


def identity_check(sales: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Revenue minus cost minus profit over all sales, which must be about zero."""
    gap = F.sum("line_revenue") - F.sum(line_cost()) - F.sum("line_profit")
    return sales.agg(money(gap).alias("difference")).withColumn(
        "holds", F.abs("difference") < F.lit(tolerance))


def key_checks(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Whether a join on the key keeps the fact's rows: unique in the dimension, found for each row.

    The fact is reduced to its distinct keys before the lookup, so a frequent key costs one row.
    """
    per_key = dimension.groupBy(key).agg(F.count("*").alias("_n"))
    doubles = per_key.agg(F.count_if(F.col("_n") > 1))
    used = fact.groupBy(key).agg(F.count("*").alias("_rows"))
    orphans = used.join(dimension.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"))
    return orphans.select(F.lit(key).alias("key_column"), "orphan_rows",
                          doubles.scalar().alias("duplicate_keys"))


def in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Smallest and largest value, and the number of rows outside the expected range."""
    return df.agg(
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        F.count_if(~F.col(column).between(low, high)).alias("outside_rows"),
    )


def coverage(df: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Expected keys that have no row."""
    return expected.select(key).distinct().join(df.select(key).distinct(), key, "left_anti")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, nulls, different values, smallest and largest.

    Every column is counted by value on its own. The scans read disjoint columns, so together they
    read the table once; a frequent value is reduced before the shuffle; and no row is copied once
    per column, as several exact distinct counts in one aggregate would do.
    """
    def one(field) -> DataFrame:
        values = df.groupBy(F.col(f"`{field.name}`").alias("_v")).agg(F.count("*").alias("_n"))
        return values.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0)).alias("null_count"),
            F.count("_v").alias("distinct_count"),
            F.min("_v").cast(StringType()).alias("min_value"),
            F.max("_v").cast(StringType()).alias("max_value"),
        ).select(F.lit(field.name).alias("column_name"),
                 F.lit(field.dataType.simpleString()).alias("column_type"), "*")

    return reduce(DataFrame.unionByName, [one(f) for f in df.schema.fields])
