"""Cleaned and joined tables at line and campaign grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import line_cost, line_profit, line_revenue, ratio
from tallyhouse.operators.filters import exclude_status, positive
from tallyhouse.operators.joins import spread_join

CANCELLED = "CANCELLED"

SALES_COLUMNS = (
    "order_id", "order_date", "channel", "order_status", "customer_id", "product_id",
    "product_name", "category", "subcategory", "quantity", "unit_price", "unit_cost",
    "discount_amount",
)

MARKETING_COLUMNS = (
    "campaign_id", "campaign_name", "category", "channel", "start_date", "spend_usd",
    "impressions", "clicks", "conversions", "attributed_revenue_usd",
)


def with_line_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("line_revenue", line_revenue())


def with_line_profit(df: DataFrame) -> DataFrame:
    return df.withColumn("line_profit", line_profit())


def with_line_cost(df: DataFrame) -> DataFrame:
    return df.withColumn("line_cost", line_cost())


def with_orders(product_lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines that carry the columns of their product, with their order and the amounts of the line.

    The order comes last: the lines leave this join by order, as a count of orders needs them. No side
    is marked for broadcast, since products and orders grow with the data; Spark broadcasts a side
    whose measured size allows it and otherwise splits the partitions of a hot product or order.
    """
    return with_amounts(product_lines.join(orders, "order_id"))


def with_amounts(joined: DataFrame) -> DataFrame:
    """Lines that carry the columns of their order and their product, with the amounts of the line."""
    return with_line_profit(with_line_revenue(joined.select(*SALES_COLUMNS)))


def order_lines(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Every line with its product and order, whatever the status; lines without either are dropped."""
    return with_orders(items.join(products, "product_id"), orders)


def build_sales(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines without cancelled orders. Returned orders stay in."""
    return order_lines(items, exclude_status(orders, CANCELLED), products)


def with_campaign_roi(df: DataFrame) -> DataFrame:
    """Attributed revenue per unit of spend, for one campaign row."""
    return df.withColumn("campaign_roi", ratio(F.col("attributed_revenue_usd"), F.col("spend_usd"), 3))


def build_marketing(campaigns: DataFrame) -> DataFrame:
    """Campaigns that spent something, with their own return on spend."""
    return with_campaign_roi(positive(campaigns.select(*MARKETING_COLUMNS), "spend_usd"))


def build_sales_evenly(items: DataFrame, orders: DataFrame, products: DataFrame, parts: int | None = None) -> DataFrame:
    """``build_sales`` where an order or a product may hold a large share of all lines.

    Both joins deal out the lines of heavy keys, so the longest task stays near the mean. Where no key is heavy
    it costs two more counts, so it is not the default.
    """
    product_lines = spread_join(items, products, "product_id", parts)
    return with_amounts(spread_join(product_lines, exclude_status(orders, CANCELLED), "order_id", parts))


def sales_with_customer(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales lines with region, country and segment of the buyer."""
    buyer = customers.select("customer_id", "region", "country", "customer_segment")
    return sales.join(buyer, "customer_id")
