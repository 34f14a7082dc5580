"""Histories, growth, seasonality and gaps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import period_end, period_start, quarter_of, safe_ratio

#: Closed date range, both ends included.
Period = tuple[date, date]


def history(sales: DataFrame, group: str, frequency: str = "month", value: str = "line_revenue",
            name: str = "month", complete: bool = False) -> DataFrame:
    """Revenue per period and group, the first day of the period as ``name``.

    With ``complete`` only periods that end no later than the newest sale of all groups are returned, so
    an unfinished last period does not look like a slump. The newest day is a maximum over the sums, whose
    shuffle the two share, so the sales are read once and no task sees all groups.
    """
    day = F.col("order_date")
    sums = sales.groupBy(period_start(day, frequency).alias(name), group).agg(
        F.sum(value).alias("revenue"), F.max(day).alias("_day"))
    if complete:
        # The revenue is asked for as well, so that both need the same sums and Spark makes them once.
        newest = sums.agg(F.struct(F.max("_day").alias("day"), F.sum("revenue"))).scalar().getField("day")
        sums = sums.filter(period_end(F.col(name), frequency) <= newest)
    return sums.select(name, group, "revenue")


def monthly_history(sales: DataFrame, group: str = "category", value: str = "line_revenue",
                    complete: bool = False) -> DataFrame:
    """Month, group and revenue."""
    return history(sales, group, "month", value, "month", complete)


def revenue_in(period: Period) -> Column:
    """Sum of line revenue inside a period, as a conditional aggregate."""
    inside = F.col("order_date").between(F.lit(period[0]), F.lit(period[1]))
    return F.coalesce(F.sum(F.when(inside, F.col("line_revenue"))), F.lit(0))


def growth_pct(first: Column, last: Column, digits: int = 1) -> Column:
    """Change from the first sum to the last in percent; 0 when there was nothing to grow from."""
    change = F.round((safe_ratio(last, first) - 1) * 100, digits)
    return F.when(first == 0, F.lit(0.0)).otherwise(change)


def growth(sales: DataFrame, first: Period, last: Period, by: str = "category") -> DataFrame:
    """Revenue of a first and a last period per group, and the change between them."""
    return sales.groupBy(by).agg(
        revenue_in(first).alias("first_revenue"),
        revenue_in(last).alias("last_revenue"),
    ).withColumn("growth_pct", growth_pct(F.col("first_revenue"), F.col("last_revenue")))


def seasonality_index(sales: DataFrame, quarter: int = 4, by: str = "category") -> DataFrame:
    """Average revenue in one quarter of the year, 100 being the average quarter.

    Only quarters that the data covers from their first to their last day count; first and last day of
    the data come from the quarterly sums, so the sales are read once. With few years the index also
    carries the trend.
    """
    day, start = F.col("order_date"), F.col("_quarter")
    quarters = sales.groupBy(by, quarter_of(day).alias("_quarter")).agg(
        F.sum("line_revenue").alias("_revenue"), F.min(day).alias("_first"), F.max(day).alias("_last"))
    # The revenue is asked for as well, so that both need the same sums and Spark makes them once.
    span = quarters.agg(F.struct(F.min("_first").alias("first"), F.max("_last").alias("last"), F.sum("_revenue"))).scalar()
    full = quarters.withColumn("_span", span).filter(
        (start >= F.col("_span.first")) & (period_end(start, "quarter") <= F.col("_span.last")))
    wanted = F.when(F.quarter("_quarter") == quarter, F.col("_revenue"))
    return full.groupBy(by).agg(
        F.sum(wanted).alias("_in"), F.count(wanted).alias("_n_in"),
        F.sum("_revenue").alias("_all"), F.count("_revenue").alias("_n_all"),
    ).select(
        by,
        F.col("_n_all").alias("full_quarters"),
        F.round(F.lit(100.0) * safe_ratio(safe_ratio(F.col("_in"), F.col("_n_in")),
                                          safe_ratio(F.col("_all"), F.col("_n_all"))), 1).alias("q_index"),
    )


def missing_dates(df: DataFrame, column: str) -> DataFrame:
    """Calendar days between the first and the last day that have no row."""
    present = df.select(F.col(column).alias("missing_date")).distinct()
    calendar = present.agg(F.min("missing_date").alias("lo"), F.max("missing_date").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("missing_date"))
    return calendar.join(present, "missing_date", "left_anti")


def recent_average(history: DataFrame, since: date, group: str = "category",
                   until: date | None = None) -> DataFrame:
    """Average monthly revenue per group from ``since`` on; ``until`` leaves out an unfinished month."""
    recent = history.filter(F.col("month") >= F.lit(since))
    if until is not None:
        recent = recent.filter(F.col("month") <= F.lit(until))
    return recent.groupBy(group).agg(F.avg("revenue").alias("recent_average"))


