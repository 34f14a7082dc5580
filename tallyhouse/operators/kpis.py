"""Business questions, each as one function over sales or marketing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.functions import money, month_of, ratio, safe_ratio
from tallyhouse.operators.gold import add_up, margin_pct, sales_totals, spend_totals, marketing_roi
from tallyhouse.operators.ranking import rank_by, top_n


def _kpis(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    return totals.select(
        *keys,
        money(F.col("total_revenue")).alias("total_revenue"),
        money(F.col("total_profit")).alias("total_profit"),
        margin_pct().alias("profit_margin_pct"),
        "units_sold",
        "order_lines",
        ratio(F.col("total_revenue"), F.col("order_lines"), 2).alias("avg_line_value"),
    )


def kpi_by(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Revenue, profit, margin, units, lines and average line value per key."""
    return _kpis(sales_totals(sales, *keys), keys)


def kpi_by_customer(sales: DataFrame, customers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same by attributes of the buyer.

    Sales are totalled per customer before customers are joined: the join then carries one row per
    customer instead of every line, and a customer with very many lines is already reduced.
    """
    per_customer = sales_totals(sales, "customer_id")
    return _kpis(add_up(per_customer.join(customers, "customer_id"), *keys), keys)


def rank_categories(sales: DataFrame, by: str = "total_profit") -> DataFrame:
    """Categories with their rank on one KPI."""
    return rank_by(kpi_by(sales, ["category"]), rank=by)


def rank_disagreement(sales: DataFrame) -> DataFrame:
    """Rank by units against rank by profit, and whether the two disagree."""
    totals = sales_totals(sales, "category").select(
        "category", "units_sold", money(F.col("total_profit")).alias("total_profit"))
    ranked = rank_by(totals, units_rank="units_sold", profit_rank="total_profit")
    return ranked.withColumn("disagrees", F.col("units_rank") != F.col("profit_rank"))


def monthly_trend(sales: DataFrame) -> DataFrame:
    """Monthly revenue per category and its change against the month before in the data.

    The window runs over monthly totals, so one group holds as many rows as there are months.
    """
    monthly = sales.groupBy("category", month_of(F.col("order_date")).alias("month")).agg(
        money(F.sum("line_revenue")).alias("revenue"))
    before = F.lag("revenue").over(W.partitionBy("category").orderBy("month"))
    return monthly.withColumn("previous_revenue", before).withColumn(
        "growth_pct",
        ratio(F.col("revenue") - F.col("previous_revenue"), F.col("previous_revenue"), 1, scale=100))


def discount_depth(sales: DataFrame) -> DataFrame:
    """Discount as a share of gross revenue, and share of lines with a discount, per category."""
    return sales.groupBy("category").agg(
        F.sum("discount_amount").alias("_discount"),
        F.sum("line_revenue").alias("_net"),
        F.count("*").alias("_lines"),
        F.count_if(F.col("discount_amount") > 0).alias("_promo"),
    ).select(
        "category",
        money(F.col("_discount")).alias("total_discount"),
        ratio(F.col("_discount"), F.col("_net") + F.col("_discount"), 2, scale=100).alias("discount_pct"),
        ratio(F.col("_promo"), F.col("_lines"), 2, scale=100).alias("promo_line_pct"),
    )


def status_rates(lines: DataFrame) -> DataFrame:
    """Returned and cancelled share of lines per category; needs lines before the status filter."""
    return lines.groupBy("category").agg(
        F.count("*").alias("order_lines"),
        F.count_if(F.col("order_status") == "RETURNED").alias("returned_lines"),
        F.count_if(F.col("order_status") == "CANCELLED").alias("cancelled_lines"),
    ).select(
        "category", "order_lines", "returned_lines", "cancelled_lines",
        ratio(F.col("returned_lines"), F.col("order_lines"), 2, scale=100).alias("return_rate_pct"),
        ratio(F.col("cancelled_lines"), F.col("order_lines"), 2, scale=100).alias("cancel_rate_pct"),
    )


def marketing_funnel(marketing: DataFrame, dimension: str) -> DataFrame:
    """Impressions, clicks and conversions with their rates and the cost of one conversion."""
    sums = ("impressions", "clicks", "conversions", "spend_usd")
    return marketing.groupBy(dimension).agg(*[F.sum(c).alias(c) for c in sums]).select(
        dimension, "impressions", "clicks", "conversions",
        money(F.col("spend_usd")).alias("spend_usd"),
        ratio(F.col("clicks"), F.col("impressions"), 3, scale=100).alias("ctr_pct"),
        ratio(F.col("conversions"), F.col("clicks"), 3, scale=100).alias("cvr_pct"),
        ratio(F.col("spend_usd"), F.col("conversions"), 2).alias("cost_per_conversion"),
    )


def product_performance(sales: DataFrame) -> DataFrame:
    """Revenue, profit and units per product."""
    return sales_totals(sales, "product_id", "product_name", "category").select(
        "product_id", "product_name", "category",
        money(F.col("total_revenue")).alias("revenue"),
        money(F.col("total_profit")).alias("profit"),
        F.col("units_sold").alias("units"),
    )


def top_products(sales: DataFrame, n: int = 5, by: str = "profit") -> DataFrame:
    """The n products with the largest figure; equal figures are decided by product id."""
    return top_n(product_performance(sales), by, n, "product_id")


def leaders(sales: DataFrame) -> DataFrame:
    """Category with the best margin next to the category with the most profit."""
    totals = sales_totals(sales, "category").withColumn(
        "_margin", safe_ratio(F.col("total_profit"), F.col("total_revenue")))
    return totals.agg(
        F.max_by("category", F.struct("_margin", "category")).alias("best_margin_category"),
        F.max_by("category", F.struct("total_profit", "category")).alias("best_profit_category"),
    ).withColumn("same_category", F.col("best_margin_category") == F.col("best_profit_category"))


def shop_overview(sales: DataFrame) -> DataFrame:
    """How many orders and lines, which dates, which categories, in one row."""
    return sales.agg(
        F.count_distinct("order_id").alias("orders"),
        F.count("*").alias("order_lines"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
        F.array_join(F.sort_array(F.collect_set("category")), ", ").alias("categories"),
    )


def forecast_by_category(forecasts: DataFrame) -> DataFrame:
    """Average handed-off forecast with its bounds, to whole currency units."""
    return forecasts.groupBy("category").agg(
        money(F.avg("forecast_revenue_usd"), 0).alias("forecast"),
        money(F.avg("lower_bound_usd"), 0).alias("lower_bound"),
        money(F.avg("upper_bound_usd"), 0).alias("upper_bound"),
    )


def daily_business(sales: DataFrame) -> DataFrame:
    """Daily totals over all categories with the operating margin."""
    return sales_totals(sales, "order_date").select(
        "order_date",
        money(F.col("total_revenue")).alias("revenue"),
        money(F.col("total_profit")).alias("profit"),
        margin_pct().alias("operating_margin_pct"),
    )


def latest(df: DataFrame, date: str, value: str) -> DataFrame:
    """The value on the newest date."""
    return df.agg(F.max(date).alias(date), F.max_by(value, date).alias(value))


def alert(df: DataFrame, breach: Column) -> DataFrame:
    """Rows that break a threshold, ``alert(daily, F.col("operating_margin_pct") < 30)``."""
    return df.filter(breach)


def category_decision(sales: DataFrame, marketing: DataFrame) -> DataFrame:
    """Profit, revenue, margin, units and marketing return side by side."""
    left = sales_totals(sales, "category")
    right = spend_totals(marketing, "category")
    return left.join(right, "category", "left").select(
        "category",
        money(F.col("total_profit"), 0).alias("profit"),
        money(F.col("total_revenue"), 0).alias("revenue"),
        margin_pct().alias("profit_margin_pct"),
        "units_sold",
        marketing_roi().alias("marketing_roi"),
    )
