"""From KPIs to a recommendation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import money, ratio
from tallyhouse.operators.gold import spend_totals
from tallyhouse.operators.timeseries import Period, growth_pct, revenue_in

DECISION = "decision"
CONTRAST = "contrast"

#: Internal signal that each external figure speaks to.
EXTERNAL_TWIN = {
    "growth": "next_quarter_growth_pct",
    "q4_index": "q4_demand_index",
    "margin": "typical_margin_pct",
}


def category_summary(sales: DataFrame, marketing: DataFrame, first: Period, last: Period) -> DataFrame:
    """Revenue, profit, margin, units, growth and marketing return per category; 0 where undefined."""
    per_category = sales.groupBy("category").agg(
        F.sum("line_revenue").alias("_revenue"),
        F.sum("line_profit").alias("_profit"),
        F.sum("quantity").alias("units"),
        revenue_in(first).alias("_first"),
        revenue_in(last).alias("_last"),
    )
    spend = spend_totals(marketing, "category")
    roi = ratio(F.col("marketing_attributed_revenue"), F.col("marketing_spend"), 1)
    return per_category.join(spend, "category", "left").select(
        "category",
        money(F.col("_revenue"), 0).alias("revenue"),
        money(F.col("_profit"), 0).alias("profit"),
        F.coalesce(ratio(F.col("_profit"), F.col("_revenue"), 1, scale=100), F.lit(0.0)).alias("margin_pct"),
        "units",
        growth_pct(F.col("_first"), F.col("_last"), 0).alias("growth_pct"),
        F.coalesce(roi, F.lit(0.0)).alias("marketing_roi"),
    )


def _best(column: str) -> Column:
    """Score and name of the category that leads on one figure; ties go to the later name."""
    score = F.col(column).cast("double")
    return F.max(F.when(score.isNotNull(), F.struct(score.alias("value"), F.col("category").alias("leader"))))


def leading(figures: DataFrame, signals: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per (signal, role, column) with the category that leads on the column.

    All leaders come from one aggregate, so the figures are computed once however many signals ask
    for them.
    """
    best = figures.agg(*[_best(column).alias(name) for name, _, column in signals])
    rows = F.array(*[
        F.struct(F.lit(name).alias("signal"), F.lit(role).alias("role"),
                 F.col(f"{name}.leader").alias("leader"), F.col(f"{name}.value").alias("value"))
        for name, role, _ in signals
    ])
    return best.select(F.inline(rows))


def decision_signals(summary: DataFrame, q4: DataFrame, outlook: DataFrame,
                     research: DataFrame | None = None) -> DataFrame:
    """One row per signal with its leading category.

    ``summary`` comes from ``category_summary``, ``q4`` from ``seasonality_index`` and ``outlook``
    is a category frame with ``forecast_revenue``. Units and margin are contrast: they are shown
    and do not vote.
    """
    signals = [
        ("profit", DECISION, "profit"),
        ("growth", DECISION, "growth_pct"),
        ("marketing_roi", DECISION, "marketing_roi"),
        ("q4_index", DECISION, "q_index"),
        ("forecast_outlook", DECISION, "forecast_revenue"),
        ("units", CONTRAST, "units"),
        ("margin", CONTRAST, "margin_pct"),
    ]
    frames = [
        summary,
        q4.select("category", "q_index"),
        outlook.groupBy("category").agg(F.avg("forecast_revenue").alias("forecast_revenue")),
    ]
    if research is not None:
        signals.append(("external_research", DECISION, "next_quarter_growth_pct"))
        frames.append(research.select("category", "next_quarter_growth_pct"))
    figures = reduce(lambda left, right: left.join(right, "category", "full_outer"), frames)
    return leading(figures, signals)


def recommend(signals: DataFrame) -> DataFrame:
    """The category that leads most decision signals; equal counts are decided by the earlier name."""
    votes = signals.filter((F.col("role") == DECISION) & F.col("leader").isNotNull())
    return votes.groupBy(F.col("leader").alias("recommended_category")).agg(
        F.count("*").alias("signals_won"),
        F.array_join(F.sort_array(F.collect_list("signal")), ", ").alias("evidence"),
    ).orderBy(F.col("signals_won").desc(), "recommended_category").limit(1)


def with_market_research(summary: DataFrame, research: DataFrame) -> DataFrame:
    """Internal figures next to the external figures of the same category, empty where there are none."""
    return summary.join(research, "category", "left")


def triangulate(internal: DataFrame, research: DataFrame) -> DataFrame:
    """Per signal, the internal and the external leader and whether they are the same.

    ``internal`` has category, growth, q4_index and margin.
    """
    figures = internal.select("category", *EXTERNAL_TWIN).join(
        research.select("category", *EXTERNAL_TWIN.values()), "category", "full_outer")
    best = figures.agg(*[_best(c).alias(c) for pair in EXTERNAL_TWIN.items() for c in pair])
    pairs = F.array(*[
        F.struct(F.lit(ours).alias("signal"), F.col(f"{ours}.leader").alias("internal_leader"),
                 F.col(f"{theirs}.leader").alias("external_leader"))
        for ours, theirs in EXTERNAL_TWIN.items()
    ])
    return best.select(F.inline(pairs)).withColumn(
        "agrees", F.col("internal_leader") == F.col("external_leader"))
