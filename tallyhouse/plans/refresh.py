"""Silver and gold tables kept up to date from the latest bronze rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import month_of
from tallyhouse.operators.gold import add_up, category_performance_of
from tallyhouse.operators.silver import build_marketing, build_sales
from tallyhouse.operators.states import daily_revenue_of, daily_states, order_baskets
from tallyhouse.sources.tables import clear_partitions, overwrite_partitions, write_table

MONTH = "order_month"


@dataclass(frozen=True)
class Schemas:
    """Names of the catalog schemas that hold the two layers."""

    silver: str = "silver"
    gold: str = "gold"

    @property
    def sales(self) -> str:
        return f"{self.silver}.sales"

    @property
    def states(self) -> str:
        return f"{self.gold}.sales_states"

    @property
    def baskets(self) -> str:
        return f"{self.gold}.order_baskets"

    @property
    def daily(self) -> str:
        return f"{self.gold}.daily_revenue"


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, month_of(F.col("order_date")))


def _recent(bronze: Mapping[str, DataFrame], first: date) -> tuple[DataFrame, DataFrame]:
    """Orders from a day on, and the lines whose order number lies in their range.

    Lines carry no date. Where order numbers rise with time, the range passes over the files of older lines;
    where they don't, it lets too much through and the join decides.
    """
    orders = bronze["fact_orders"].filter(F.col("order_date") >= F.lit(first))
    low, high = orders.agg(F.min("order_id"), F.max("order_id")).first()
    return orders, bronze["fact_order_items"].filter(F.col("order_id").between(low, high))


def _derive(spark: SparkSession, names: Schemas, put, in_reach) -> None:
    """The parts and the daily table of the months in reach, from the stored sales of just these months."""
    sales = spark.table(names.sales).filter(in_reach)
    put(_by_month(daily_states(sales)), names.states, "Sums by day and category that add up")
    put(_by_month(order_baskets(sales)), names.baskets, "Orders by day and set of categories")
    daily = daily_revenue_of(*(spark.table(n).filter(in_reach).drop(MONTH) for n in (names.states, names.baskets)))
    put(_by_month(daily), names.daily, "Day by category")


def _refresh_months(spark: SparkSession, bronze: Mapping[str, DataFrame], names: Schemas, first: date) -> None:
    """Replace the months from ``first`` on in every table by month; one that has lost all its rows is emptied.

    The months written are observed while writing, without another pass; the calendar bounds their number.
    """
    in_reach = F.col(MONTH) >= F.lit(first)
    before = {row[0] for row in spark.table(names.states).filter(in_reach).select(MONTH).distinct().collect()}
    orders, items = _recent(bronze, first)
    seen = Observation()
    sales = _by_month(build_sales(items, orders, bronze["dim_product"]))
    overwrite_partitions(sales.observe(seen, F.collect_set(MONTH).alias("months")), names.sales)
    gone = sorted(before - set(seen.get["months"] or []))
    clear_partitions(spark, names.sales, MONTH, gone)
    _derive(spark, names, lambda df, name, comment: overwrite_partitions(df, name), in_reach)
    for name in (names.states, names.baskets, names.daily):
        clear_partitions(spark, name, MONTH, gone)


def refresh(spark: SparkSession, bronze: Mapping[str, DataFrame], schemas: Schemas = Schemas(),
            since: date | None = None) -> None:
    """Rebuild everything, or from the month of ``since`` on.

    Tables by order date are partitioned by month. With ``since`` only the orders of those months and the
    lines in the range of their numbers are read, and only those partitions are replaced. Category
    performance is added up from the stored sums by day, of all months, whose number the calendar bounds; the
    lines of other months are not read. Running twice gives the same tables.
    """
    for name in (schemas.silver, schemas.gold):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    if since is not None and all(map(spark.catalog.tableExists, (
            schemas.sales, schemas.states, schemas.baskets, schemas.daily))):
        _refresh_months(spark, bronze, schemas, since.replace(day=1))
    else:
        sales = build_sales(bronze["fact_order_items"], bronze["fact_orders"], bronze["dim_product"])
        write_table(_by_month(sales), schemas.sales, "Order lines without cancelled orders", [MONTH])
        _derive(spark, schemas, lambda df, name, comment: write_table(df, name, comment, [MONTH]), F.lit(True))

    marketing = write_table(build_marketing(bronze["fact_marketing_campaigns"]), f"{schemas.silver}.marketing",
                            "Campaigns that spent something")
    write_table(category_performance_of(add_up(spark.table(schemas.states), "category"), marketing),
                f"{schemas.gold}.category_performance", "One row per category")
