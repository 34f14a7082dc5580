"""The retail star schema as views over order-processing tables.

Maps customer, nation, region, part, orders, lineitem and events onto the dimension and fact tables
that the operators expect. Every function reads whole tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.filters import exclude_status
from tallyhouse.operators.silver import CANCELLED, build_marketing, with_amounts, with_orders
from tallyhouse.operators.timeseries import monthly_history, recent_average


@dataclass(frozen=True)
class Fault:
    """A planted fault: the point as a multiple of recent actuals, the bounds as multiples of the point."""

    factor: float
    low: float
    high: float


# Fixed values of the mapping: categories by user number, marketing channels by quarter of the day,
# order status by source code, and the calendar of the order history.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CHANNELS = ("Paid Search", "Paid Social", "Email", "Display")
STATUS = {"P": "CANCELLED", "O": "RETURNED", "F": "COMPLETED"}
FIRST_QUARTER = (date(1995, 1, 1), date(1995, 3, 31))
LAST_QUARTER = (date(2001, 5, 1), date(2001, 7, 31))
RECENT_SINCE = date(2001, 5, 1)
FORECAST_MONTHS = (date(2001, 8, 1), date(2001, 9, 1), date(2001, 10, 1))
GENERATED_ON = date(2001, 7, 28)
FORECAST_BASE = 8000
LINES_PER_TASK = 500_000
FAULTS = {
    "ECONOMY": Fault(factor=0.1, low=0.95, high=1.05),
    "LARGE": Fault(factor=8.0, low=1.05, high=1.15),
    "MEDIUM": Fault(factor=-0.1, low=1.05, high=0.95),
    "PROMO": Fault(factor=1.0, low=-4.0, high=6.0),
    "SMALL": Fault(factor=1.0, low=0.95, high=1.05),
    "STANDARD": Fault(factor=0.9, low=0.95, high=1.05),
}


def _nth(values: tuple[str, ...], index: str) -> str:
    """SQL for the value at a zero-based index."""
    return f"element_at(array({', '.join(repr(v) for v in values)}), CAST({index} AS INT) + 1)"


def faulty_forecast(recent: DataFrame, months: Sequence[date], faults: Mapping[str, Fault],
                    generated_on: date) -> DataFrame:
    """A handed-off forecast that is wrong on purpose, from recent averages per category."""
    planted = recent.sparkSession.createDataFrame(
        [(k, name, f.factor, f.low, f.high) for k, (name, f) in enumerate(faults.items())],
        "_k INT, category STRING, _factor DOUBLE, _low DOUBLE, _high DOUBLE")
    rows = recent.join(planted, "category").withColumn(
        "_point", F.round(F.col("recent_average").cast("double") * F.col("_factor"), 2))
    when = F.posexplode(F.array(*[F.lit(m) for m in months])).alias("_m", "forecast_month")
    amount = "decimal(18,2)"
    return rows.select("*", when).select(
        (F.col("_k") * len(months) + F.col("_m") + FORECAST_BASE + 1).alias("forecast_id"),
        "category", "forecast_month",
        F.col("_point").cast(amount).alias("forecast_revenue_usd"),
        F.round(F.col("_point") * F.col("_low"), 2).cast(amount).alias("lower_bound_usd"),
        F.round(F.col("_point") * F.col("_high"), 2).cast(amount).alias("upper_bound_usd"),
        F.lit("handoff_model").alias("model_name"),
        F.lit("forecast_desk").alias("generated_by"),
        F.lit(generated_on).alias("generated_date"),
    )


def handed_off_forecast(history: DataFrame) -> DataFrame:
    """A forecast from elsewhere, with planted faults."""
    return faulty_forecast(recent_average(history, RECENT_SINCE), FORECAST_MONTHS, FAULTS, GENERATED_ON)


@dataclass(frozen=True)
class Star:
    """Lazy frames over one directory of tables."""

    spark: SparkSession
    directory: str
    _tables: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)
    _counts: dict[str, int] = field(default_factory=dict, repr=False, compare=False)

    def table(self, name: str) -> DataFrame:
        """A given table; its footers are read once per star."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._tables[name]

    @property
    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS product_id", "p_name AS product_name", "p_type AS category", "p_brand AS subcategory",
            "CAST(p_retailprice AS DECIMAL(12,2)) AS list_price",
            "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.60BD AS DECIMAL(10,4)) AS unit_cost")

    @property
    def customers(self) -> DataFrame:
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.table("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
            "c_custkey AS customer_id", "r_name AS region", "n_name AS country", "c_mktsegment AS customer_segment")

    def _orders(self, where: str = "true") -> DataFrame:
        """``where`` is over the source columns, so that it reaches the scan."""
        status = " ".join(f"WHEN '{code}' THEN '{name}'" for code, name in STATUS.items())
        return self.table("orders").where(where).selectExpr(
            "o_orderkey AS order_id", "o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS order_date",
            "o_orderdate AS order_ts", "o_orderpriority AS channel", f"CASE o_orderstatus {status} END AS order_status")

    @property
    def orders(self) -> DataFrame:
        return self._orders()

    @property
    def _raw_lines(self) -> DataFrame:
        """Keys, quantity and discount of the lines, all that a join by order has to carry.

        Discounts become DECIMAL through whole percents, since a cast from DOUBLE to DECIMAL goes through text
        and would dominate a scan of the lines.
        """
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id", "l_partkey AS product_id", "CAST(l_quantity AS INT) AS quantity",
            "0.01BD * CAST(CAST(rint(100 * l_discount) AS INT) AS DECIMAL(3,0)) AS off")

    def _priced(self, lines: DataFrame) -> DataFrame:
        """Lines with their product, priced from the same part row; the source has no item key.

        Prices become DECIMAL once per part. They have ten digits, so that amounts of a line fit into a long.
        """
        parts = self.products.selectExpr("*", "CAST(list_price AS DECIMAL(8,2)) AS price")
        others = [c for c in lines.columns if c not in ("product_id", "quantity", "off")]
        priced = lines.join(parts, "product_id").selectExpr(
            *others, "product_id", "product_name", "category", "subcategory", "quantity", "price",
            "CAST(price * (1 - off) AS DECIMAL(10,4)) AS unit_price", "unit_cost")
        return priced.selectExpr(
            "*", "CAST(CAST(quantity AS DECIMAL(7,0)) * CAST(price - unit_price AS DECIMAL(10,4)) AS DECIMAL(18,4)) "
                 "AS discount_amount")

    @property
    def product_lines(self) -> DataFrame:
        return self._priced(self._raw_lines)

    @property
    def items(self) -> DataFrame:
        return self.product_lines.select("order_id", "product_id", "quantity", "unit_price", "discount_amount")

    @property
    def lines(self) -> DataFrame:
        return with_orders(self.product_lines, self.orders)

    @property
    def _kept_orders(self) -> DataFrame:
        """Orders that are not cancelled; the source code of the others is left out at the scan."""
        cancelled = next(code for code, name in STATUS.items() if name == CANCELLED)
        return exclude_status(self._orders(f"o_orderstatus <> '{cancelled}'"), CANCELLED)

    @property
    def sales(self) -> DataFrame:
        """Lines without cancelled orders. Orders come first, while lines are narrow and before their prices are
        worked out; products, the smaller table, come last."""
        return with_amounts(self._priced(self._raw_lines.join(self._kept_orders, "order_id")))

    @property
    def sales_by_order(self) -> DataFrame:
        """``sales`` for results that hold a row per order in memory, such as a count of different orders.

        Partitions that are joined up by their bytes hold millions of narrow lines, each of which becomes a
        wider row there. Here orders come last, and both sides of that join are dealt out into parts of about
        ``LINES_PER_TASK`` lines, so the memory of a task stays as the table grows. Smaller tables are left to
        Spark.
        """
        parts = -(-self._n_lines() // LINES_PER_TASK)
        if parts <= self.spark.sparkContext.defaultParallelism:
            return self.sales
        return with_orders(self.product_lines.repartition(parts, "order_id"),
                           self._kept_orders.repartition(parts, "order_id"))

    def _n_lines(self) -> int:
        """Counted from the footers, once per star."""
        if "lineitem" not in self._counts:
            self._counts["lineitem"] = self.table("lineitem").count()
        return self._counts["lineitem"]

    @property
    def campaigns(self) -> DataFrame:
        """One campaign per category, day and channel, from web events."""
        events = self.table("events").selectExpr(
            f"{_nth(CATEGORIES, 'user_id % 6')} AS category",
            "CAST(ts AS DATE) AS start_date",
            f"{_nth(CHANNELS, 'floor(hour(ts) / 6)')} AS channel",
            "event_type",
            "CAST(value AS DECIMAL(12,2)) AS amount")
        cells = events.groupBy("category", "start_date", "channel").agg(
            F.expr("coalesce(sum(amount) FILTER (WHERE event_type = 'click'), 0)").alias("spend_usd"),
            F.expr("count_if(event_type = 'view')").alias("impressions"),
            F.expr("count_if(event_type = 'click')").alias("clicks"),
            F.expr("count_if(event_type = 'purchase')").alias("conversions"),
            F.expr("coalesce(sum(amount) FILTER (WHERE event_type = 'purchase'), 0)").alias("attributed_revenue_usd"),
        )
        return cells.selectExpr(
            "*", "concat_ws(' ', category, CAST(start_date AS STRING), channel) AS campaign_name",
            "concat_ws(' ', category, CAST(start_date AS STRING), channel) AS campaign_id")

    @property
    def marketing(self) -> DataFrame:
        return build_marketing(self.campaigns)

    @property
    def history(self) -> DataFrame:
        return monthly_history(self.sales, complete=True)

    @property
    def forecasts(self) -> DataFrame:
        return handed_off_forecast(self.history)

    @property
    def research(self) -> DataFrame:
        """Market figures per category from the same events, standing in for an external brief."""
        events = self.table("events").selectExpr(
            f"{_nth(CATEGORIES, 'user_id % 6')} AS category", "user_id", "event_type",
            "day(ts) AS day", "hour(ts) AS hour", "CAST(value AS DECIMAL(12,2)) AS amount")
        per_user = events.groupBy("category", "user_id").agg(
            F.expr("sum(amount)").alias("total"),
            F.expr("sum(amount) FILTER (WHERE day <= 15)").alias("early"),
            F.expr("sum(amount) FILTER (WHERE day > 15)").alias("late"),
            F.expr("sum(amount) FILTER (WHERE hour >= 18)").alias("evening"),
            F.expr("sum(amount) FILTER (WHERE event_type = 'purchase')").alias("bought"),
            F.expr("count_if(event_type = 'purchase')").alias("purchases"),
        )
        sums = per_user.groupBy("category").agg(
            *[F.expr(f"CAST(sum({c}) AS DOUBLE)").alias(c)
              for c in ("total", "early", "late", "evening", "bought", "purchases")],
            F.expr("CAST(count_if(purchases >= 2) AS DOUBLE)").alias("repeat_buyers"),
            F.expr("CAST(count_if(purchases >= 1) AS DOUBLE)").alias("buyers"),
        )
        return sums.selectExpr(
            "category",
            "round(100d * (try_divide(late, early) - 1), 2) AS next_quarter_growth_pct",
            "round(400d * try_divide(evening, total), 1) AS q4_demand_index",
            "round(try_divide(bought, purchases), 2) AS willingness_to_pay",
            "round(100d * try_divide(bought, total), 2) AS typical_margin_pct",
            "round(100d * try_divide(repeat_buyers, buyers), 2) AS repeat_rate_pct")
