"""Calendar buckets and period arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Length of one period, as the interval that ``sequence`` steps by.
PERIOD_STEP = {
    "day": "interval 1 day",
    "week": "interval 7 days",
    "month": "interval 1 month",
    "quarter": "interval 3 months",
    "year": "interval 1 year",
}


def month_of(date: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(date, "MM")


def quarter_of(date: Column) -> Column:
    """First day of the quarter, as DATE."""
    return F.trunc(date, "quarter")


def period_start(date: Column, frequency: str = "month") -> Column:
    """First day of the period; weeks begin on the weekday of 1970-01-01."""
    days = F.datediff(date, F.lit("1970-01-01").cast("date"))
    return {
        "day": date,
        "week": F.date_sub(date, F.pmod(days, F.lit(7))),
        "month": F.trunc(date, "MM"),
        "quarter": F.trunc(date, "quarter"),
        "year": F.trunc(date, "year"),
    }[frequency]


def period_end(start: Column, frequency: str = "month") -> Column:
    """Last day of the period that begins on ``start``."""
    return F.date_sub((start + F.expr(PERIOD_STEP[frequency])).cast("date"), 1)


def period_index(date: Column, frequency: str = "month") -> Column:
    """Whole periods since 1970-01-01, so that a missing period leaves a gap in the index."""
    months = (F.year(date) - 1970) * 12 + F.month(date) - 1
    days = F.datediff(date, F.lit("1970-01-01").cast("date"))
    return {
        "day": days,
        "week": F.floor(days / 7),
        "month": months,
        "quarter": F.floor(months / 3),
        "year": F.year(date) - 1970,
    }[frequency].cast("int")
