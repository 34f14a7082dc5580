"""Aggregates that answer most questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import money, ratio
from tallyhouse.functions.amounts import line_cost


def sales_totals(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Revenue, profit, units and lines per key, unrounded.

    All four can be added up again, so a caller may total by a fine key first and by a coarser one
    after a join.
    """
    return df.groupBy(*keys).agg(
        F.sum("line_revenue").alias("total_revenue"),
        F.sum("line_profit").alias("total_profit"),
        F.sum("quantity").alias("units_sold"),
        F.count("*").alias("order_lines"),
    )


def compact_sales(sales: DataFrame, *keys: str) -> DataFrame:
    """Sales reduced to one row per key, under the same column names.

    Operators that only add up revenue, profit and units accept it in place of the lines. By day and
    category it stays small whatever the size of the shop, so it is the frame to store when several
    results are drawn from the same sales.
    """
    return sales.groupBy(*keys).agg(*[
        F.sum(name).alias(name)
        for name in ("line_revenue", "line_profit", "quantity")])


def add_up(totals: DataFrame, *keys: str | Column) -> DataFrame:
    """Coarser totals from finer ones made by ``sales_totals``."""
    names = ("total_revenue", "total_profit", "units_sold", "order_lines")
    return totals.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def spend_totals(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("spend_usd").alias("marketing_spend"),
        F.sum("attributed_revenue_usd").alias("marketing_attributed_revenue"),
    )


def margin_pct(digits: int = 1) -> Column:
    return ratio(F.col("total_profit"), F.col("total_revenue"), digits, scale=100)


def marketing_roi(digits: int = 2) -> Column:
    """Attributed revenue divided by spend, from the two sums."""
    return ratio(F.col("marketing_attributed_revenue"), F.col("marketing_spend"), digits)


def build_category_performance(sales: DataFrame, marketing: DataFrame) -> DataFrame:
    """One row per category with sales and marketing figures.

    Both sides are reduced to one row per category before they meet, since lines and campaigns are
    many-to-many on category. A category without campaigns keeps NULL marketing columns.
    """
    return category_performance_of(sales_totals(sales, "category"), marketing)


def category_performance_of(per_category: DataFrame, marketing: DataFrame) -> DataFrame:
    """The same from totals that are already one row per category."""
    spend = spend_totals(marketing, "category")
    return per_category.join(spend, "category", "left").select(
        "category",
        money(F.col("total_revenue")).alias("total_revenue"),
        money(F.col("total_profit")).alias("total_profit"),
        "units_sold",
        "order_lines",
        margin_pct().alias("profit_margin_pct"),
        money(F.col("marketing_spend")).alias("marketing_spend"),
        money(F.col("marketing_attributed_revenue")).alias("marketing_attributed_revenue"),
        marketing_roi().alias("marketing_roi"),
    )


def build_daily_revenue(sales: DataFrame) -> DataFrame:
    """Day by category. ``orders`` counts an order once per category, so it must not be added up.

    Spark reduces the lines to one row per day, category and order before counting, so no task ever
    holds all orders of a busy day.
    """
    return sales.groupBy("order_date", "category").agg(
        money(F.sum("line_revenue")).alias("daily_revenue"),
        money(F.sum("line_profit")).alias("daily_profit"),
        F.sum("quantity").alias("daily_units"),
        F.count_distinct("order_id").alias("orders"),
    )


def marketing_by(marketing: DataFrame, dimension: str) -> DataFrame:
    """Campaigns, spend, attributed revenue and blended return per dimension value."""
    return marketing.groupBy(dimension).agg(
        F.count("*").alias("campaigns"),
        F.sum("spend_usd").alias("marketing_spend"),
        F.sum("attributed_revenue_usd").alias("marketing_attributed_revenue"),
    ).select(
        dimension,
        "campaigns",
        money(F.col("marketing_spend"), 0).alias("total_spend"),
        money(F.col("marketing_attributed_revenue"), 0).alias("total_attributed"),
        marketing_roi().alias("blended_roi"),
    )


def status_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_status").agg(F.count("*").alias("lines"))


def overall_kpis(sales: DataFrame) -> DataFrame:
    """One row over all sales, with the profit identity next to the margin."""
    return sales.agg(
        F.sum("line_revenue").alias("total_revenue"),
        F.sum(line_cost()).alias("total_cost"),
        F.sum("line_profit").alias("total_profit"),
    ).select(
        money(F.col("total_revenue")).alias("total_revenue"),
        money(F.col("total_cost")).alias("total_cost"),
        money(F.col("total_profit")).alias("total_profit"),
        margin_pct().alias("overall_margin_pct"),
        money(F.col("total_revenue") - F.col("total_cost") - F.col("total_profit")).alias("profit_identity"),
    )


def date_coverage(df: DataFrame, column: str) -> DataFrame:
    """First day, last day and number of different days."""
    return df.agg(
        F.min(column).alias("first_day"),
        F.max(column).alias("last_day"),
        F.count_distinct(column).alias("distinct_days"),
    )


def rough_peek(items: DataFrame, orders: DataFrame, products: DataFrame, excluded: str = "CANCELLED") -> DataFrame:
    """Revenue by category straight from the raw tables, to whole currency units.

    Lines are totalled by product before products are joined, so the category lookup sees one row
    per product and a hot product is already reduced.
    """
    kept = orders.filter(F.col("order_status") != excluded).select("order_id")
    per_product = items.join(kept, "order_id").groupBy("product_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("_revenue"),
        F.sum("quantity").alias("_units"),
    )
    return per_product.join(products.select("product_id", "category"), "product_id").groupBy("category").agg(
        money(F.sum("_revenue"), 0).alias("gross_revenue_usd"),
        F.sum("_units").alias("units_sold"),
    )
