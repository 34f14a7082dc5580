"""Typed schemas of the six source tables, with their keys and cursors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


def _schema(**columns: str) -> StructType:
    schema = StructType()
    for name, type_name in columns.items():
        schema.add(name, type_name)
    return schema


# Column names and types of the source tables.
SCHEMAS: dict[str, StructType] = {
    "dim_product": _schema(
        product_id="integer", product_name="string", category="string", subcategory="string",
        list_price="decimal(10,2)", unit_cost="decimal(10,2)", launch_date="date", is_active="boolean"),
    "dim_customer": _schema(
        customer_id="integer", first_name="string", last_name="string", email="string", region="string",
        country="string", customer_segment="string", signup_date="date"),
    "fact_orders": _schema(
        order_id="long", customer_id="integer", order_date="date", order_ts="timestamp", channel="string",
        order_status="string", shipping_cost="decimal(10,2)"),
    "fact_order_items": _schema(
        order_item_id="long", order_id="long", product_id="integer", quantity="integer",
        unit_price="decimal(10,2)", discount_amount="decimal(10,2)"),
    "fact_marketing_campaigns": _schema(
        campaign_id="integer", campaign_name="string", category="string", channel="string",
        start_date="date", end_date="date", spend_usd="decimal(12,2)", impressions="long", clicks="long",
        conversions="integer", attributed_revenue_usd="decimal(12,2)"),
    "fact_sales_forecast": _schema(
        forecast_id="integer", category="string", forecast_month="date",
        forecast_revenue_usd="decimal(12,2)", lower_bound_usd="decimal(12,2)",
        upper_bound_usd="decimal(12,2)", model_name="string", generated_by="string", generated_date="date"),
}

#: External research brief, one row per category.
MARKET_RESEARCH = _schema(
    category="string", next_quarter_growth_pct="double", q4_demand_index="double",
    willingness_to_pay="double", typical_margin_pct="double", repeat_rate_pct="double")


@dataclass(frozen=True)
class SourceTable:
    """One manifest line: which table, what identifies a row, what tells a newer row."""

    name: str
    primary_key: str
    cursor: str


# Primary key and cursor column per table.
MANIFEST = (
    SourceTable("dim_product", "product_id", "product_id"),
    SourceTable("dim_customer", "customer_id", "customer_id"),
    SourceTable("fact_orders", "order_id", "order_ts"),
    SourceTable("fact_order_items", "order_item_id", "order_item_id"),
    SourceTable("fact_marketing_campaigns", "campaign_id", "campaign_id"),
    SourceTable("fact_sales_forecast", "forecast_id", "forecast_id"),
)
