"""Forecasts per group, and checks on a forecast from elsewhere."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import money, ratio
from tallyhouse.functions.dates import PERIOD_STEP, period_index
from tallyhouse.operators.timeseries import recent_average

#: Half-width of the band in residual standard errors (95 % of a normal spread).
BAND_Z = 1.96

#: Seasonal positions per frequency, and how many full cycles a series must hold to use them.
SEASON_LENGTH = {"day": 7, "week": 52, "month": 12, "quarter": 4, "year": 1}
MIN_CYCLES = 2


def _fit(points: DataFrame, group: str) -> DataFrame:
    """Least-squares line per group from running sums, so no group is gathered in one place."""
    y, x = F.col("_y"), F.col("_x")
    fit = points.groupBy(group).agg(
        F.max("_t").alias("_last"),
        F.count("_y").alias("_n"),
        F.avg("_y").alias("_y_mean"),
        F.avg("_x").alias("_x_mean"),
        F.regr_slope(y, x).alias("_slope"),
        F.regr_sxx(y, x).alias("_sxx"),
        F.regr_syy(y, x).alias("_syy"),
        F.regr_sxy(y, x).alias("_sxy"),
        (F.max("_x") - F.min("_x") + 1).alias("_span"),
    )
    unexplained = F.col("_syy") - F.try_divide(F.col("_sxy") * F.col("_sxy"), F.col("_sxx"))
    spread = F.sqrt(F.greatest(unexplained, F.lit(0.0)) / (F.col("_n") - 2))
    return fit.select(
        group, "_last", "_n", "_span", "_y_mean", "_x_mean",
        F.coalesce("_slope", F.lit(0.0)).alias("_slope"),
        F.when(F.col("_n") > 2, F.coalesce(spread, F.lit(0.0))).otherwise(0.0).alias("_spread"),
    )


def _trend_at(x: Column) -> Column:
    return F.col("_y_mean") + F.col("_slope") * (x - F.col("_x_mean"))


def forecast(history: DataFrame, horizon: date, time_col: str, value_col: str, group_col: str,
             frequency: str = "month", seasonal: bool = False) -> DataFrame:
    """Point forecast with a lower and upper bound for every period up to ``horizon``.

    The model is a straight line through each group's history, indexed by calendar period so that
    a missing period keeps its place. The band is 1.96 residual standard errors. One point gives a
    flat forecast, and a perfect line a band of width zero. A horizon inside a period leaves that period
    out.

    ``seasonal`` adds the average deviation from the line at the same position of the cycle (month
    of the year, day of the week) for groups that span at least two cycles; other groups keep the
    plain line. The band stays that of the line, which includes the season and is therefore wide.
    ``model`` names what each row comes from: ``line`` or ``line and season``.
    """
    points = history.select(
        F.col(group_col),
        F.col(time_col).alias("_t"),
        period_index(F.col(time_col), frequency).alias("_x"),
        F.col(value_col).cast("double").alias("_y"),
    )
    fit = _fit(points, group_col)
    step = F.expr(PERIOD_STEP[frequency])
    first = (F.col("_last") + step).cast("date")
    future = fit.filter(first <= F.lit(horizon)).withColumn(
        time_col, F.explode(F.sequence(first, F.lit(horizon), step))).withColumns({
            "_point": _trend_at(period_index(F.col(time_col), frequency)), "model": F.lit("line")})
    if seasonal:
        future = _add_season(future, points, fit, group_col, time_col, frequency)
    half = F.lit(BAND_Z) * F.col("_spread")
    return future.select(
        group_col, time_col,
        F.round("_point", 2).alias(f"{value_col}_forecast"),
        F.round(F.col("_point") - half, 2).alias(f"{value_col}_lower"),
        F.round(F.col("_point") + half, 2).alias(f"{value_col}_upper"),
        "model",
    )


def _add_season(future: DataFrame, points: DataFrame, fit: DataFrame, group: str, time: str,
                frequency: str) -> DataFrame:
    length = SEASON_LENGTH[frequency]
    cycles = F.col("_span") >= MIN_CYCLES * length
    deviations = points.join(fit, group).filter(cycles).groupBy(
        group, F.pmod("_x", F.lit(length)).alias("_season")).agg(
        F.avg(F.col("_y") - _trend_at(F.col("_x"))).alias("_shift"))
    position = F.pmod(period_index(F.col(time), frequency), F.lit(length))
    return future.withColumn("_season", position).join(deviations, [group, "_season"], "left").withColumns({
        "_point": F.col("_point") + F.coalesce("_shift", F.lit(0.0)),
        "model": F.when(cycles, F.lit("line and season")).otherwise(F.col("model"))})


def baseline_forecast(history: DataFrame, since: date, months: Sequence[date], band: float = 0.1,
                      until: date | None = None) -> DataFrame:
    """Average of the months from ``since`` on, repeated for each given month, with a fixed band."""
    recent = recent_average(history, since, until=until)
    average = F.col("recent_average")
    return recent.select(
        "category",
        F.explode(F.array(*[F.lit(m) for m in months])).alias("forecast_month"),
        money(average).alias("forecast_revenue"),
        F.round(average.cast("double") * (1 - band), 2).alias("lower_bound"),
        F.round(average.cast("double") * (1 + band), 2).alias("upper_bound"),
    )


# Texts that a reader of the report looks for.
NEGATIVE = "IMPOSSIBLE: negative revenue"
BOUND_ABOVE_POINT = "BROKEN: lower bound above point forecast"
BAND_TOO_WIDE = "SUSPECT: uncertainty band absurdly wide"


def forecast_anomalies(forecasts: DataFrame, width: int = 3) -> DataFrame:
    """Forecast rows that cannot be right, each with the first rule it breaks.

    Negative point, then lower bound above the point, then a band wider than ``width`` times the
    point.
    """
    point, low, high = F.col("forecast_revenue_usd"), F.col("lower_bound_usd"), F.col("upper_bound_usd")
    rule = (
        F.when(point < 0, F.lit(NEGATIVE))
        .when(low > point, F.lit(BOUND_ABOVE_POINT))
        .when(high - low > width * F.abs(point), F.lit(BAND_TOO_WIDE))
    )
    return forecasts.select(
        "category", "forecast_month", "forecast_revenue_usd", "lower_bound_usd", "upper_bound_usd",
        rule.alias("anomaly"),
    ).filter(F.col("anomaly").isNotNull())


def compare_forecasts(history: DataFrame, own: DataFrame, other: DataFrame, since: date,
                      own_value: str = "forecast_revenue", until: date | None = None) -> DataFrame:
    """Recent actuals, our forecast and the handed-off forecast side by side, per category.

    Each side is one row per category before they meet.
    """
    actual = recent_average(history, since, until=until).select(
        "category", money(F.col("recent_average"), 0).alias("recent_monthly_actual"))
    ours = own.groupBy("category").agg(F.round(F.avg(own_value), 0).alias("own_forecast"))
    theirs = other.groupBy("category").agg(
        money(F.avg("forecast_revenue_usd"), 0).alias("other_forecast"),
        money(F.avg("lower_bound_usd"), 0).alias("other_lower"),
        money(F.avg("upper_bound_usd"), 0).alias("other_upper"),
    )
    off = F.col("other_forecast") - F.col("recent_monthly_actual")
    return actual.join(ours, "category").join(theirs, "category").select(
        "*",
        F.round(F.col("other_forecast") - F.col("own_forecast"), 0).alias("other_minus_own"),
        ratio(off, F.col("recent_monthly_actual"), 0, scale=100).alias("other_vs_actual_pct"),
    )


def swing_anomalies(comparison: DataFrame, limit: float = 0.5) -> DataFrame:
    """Categories whose handed-off forecast is more than ``limit`` away from recent actuals."""
    return comparison.filter(F.abs("other_vs_actual_pct") > 100 * limit)


def with_disagreement(comparison: DataFrame) -> DataFrame:
    """Comparison rows with the size of the difference between the two forecasts."""
    return comparison.withColumn("disagreement", F.abs("other_minus_own"))


def by_disagreement(comparison: DataFrame) -> DataFrame:
    """Comparison rows, largest difference between the two forecasts first."""
    return with_disagreement(comparison).orderBy(F.col("disagreement").desc(), "category")
