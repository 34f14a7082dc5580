"""Gold tables kept as parts that add up: sums by day, and orders by the categories they hold.

A refresh replaces the parts of the months it touches; every coarser figure comes from the parts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import money, month_of
from tallyhouse.operators.gold import sales_totals

DAY = "order_date"
#: The kinds of totals that ``order_counts`` returns.
GRAINS = ("day and category", "month and category", "category", "total")


def daily_states(sales: DataFrame) -> DataFrame:
    """Unrounded sums by day and category, from which ``add_up`` makes any coarser total."""
    return sales_totals(sales, DAY, "category")


def order_baskets(sales: DataFrame) -> DataFrame:
    """How many orders of a day hold just these categories.

    A distinct count per category does not add up, since an order may hold several; the number of orders
    per set of categories does, because an order has one day and one set. The sets of an order are reduced
    before the shuffle, and the result has at most one row per day and set that occurs.
    """
    held = sales.groupBy("order_id", DAY).agg(F.sort_array(F.collect_set(F.struct("category"))).alias("basket"))
    return held.groupBy(DAY, "basket").agg(F.count(F.lit(1)).alias("orders"))


def distinct_orders(baskets: DataFrame, *keys: Column, by_category: bool = True) -> DataFrame:
    """Distinct orders by keys over the day, and by category unless told otherwise, from stored baskets."""
    if by_category:
        baskets = baskets.withColumn("category", F.explode("basket")).withColumn("category", F.col("category.category"))
    return baskets.groupBy(*keys, *(["category"] if by_category else [])).agg(F.sum("orders").alias("orders"))


def order_counts(baskets: DataFrame) -> DataFrame:
    """Distinct orders by day and category, by month and category, by category and in all."""
    day, month = F.col(DAY).alias("period"), month_of(F.col(DAY)).alias("period")
    parts = [distinct_orders(baskets, day), distinct_orders(baskets, month), distinct_orders(baskets),
             distinct_orders(baskets, by_category=False)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [part.withColumn("grain", F.lit(name)) for name, part in zip(GRAINS, parts)]).select(
        "grain", "period", "category", "orders")


def daily_revenue_of(states: DataFrame, baskets: DataFrame) -> DataFrame:
    """Day by category as ``build_daily_revenue`` has it, from the stored parts."""
    counted = distinct_orders(baskets, F.col(DAY).alias("_day")).withColumnRenamed("category", "_category")
    same = F.col(DAY).eqNullSafe(F.col("_day")) & F.col("category").eqNullSafe(F.col("_category"))
    return states.join(counted, same).select(
        DAY, "category",
        money(F.col("total_revenue")).alias("daily_revenue"),
        money(F.col("total_profit")).alias("daily_profit"),
        F.col("units_sold").alias("daily_units"),
        "orders",
    )
