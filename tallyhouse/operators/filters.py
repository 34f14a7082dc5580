"""Row filters with the null and boundary rules of the tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exclude_status(df: DataFrame, status: str) -> DataFrame:
    """Rows with another status. A NULL status is dropped too, as ``<>`` is not true for it."""
    return df.filter(F.col("order_status") != status)


def with_value(df: DataFrame, column: str, *values: object) -> DataFrame:
    """Rows whose column equals one of the values."""
    return df.filter(F.col(column).isin(*values))


def positive(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is present and greater than zero."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) > 0))


def between_dates(df: DataFrame, column: str, first: date | None = None,
                  last: date | None = None) -> DataFrame:
    """Rows from ``first`` to ``last``, both included; None leaves that side open."""
    if first is not None:
        df = df.filter(F.col(column) >= F.lit(first))
    if last is not None:
        df = df.filter(F.col(column) <= F.lit(last))
    return df


def last_n_days(df: DataFrame, column: str, days: int, newest: Column | date | None = None,
                totals: bool = False) -> DataFrame:
    """The last ``days`` days, counted back from the newest date.

    Without ``newest`` the date is the greatest of the frame. It is found by a distributed maximum; a frame of
    totals shares its shuffle with it and is computed once, any other is read a second time. With
    ``newest``, the filter reaches the files. ``totals`` makes no difference any more.
    """
    return _back_from(df, column, newest, lambda day: F.col(column) > F.date_sub(day, days))


def last_n_months(df: DataFrame, column: str, months: int, newest: Column | date | None = None,
                  totals: bool = False) -> DataFrame:
    """The calendar month of the newest date and the ``months - 1`` months before it."""
    return _back_from(df, column, newest, lambda day: F.col(column) >= F.add_months(F.trunc(day, "MM"), 1 - months))


def _back_from(df: DataFrame, column: str, newest: Column | date | None, keep) -> DataFrame:
    if newest is None:
        newest = df.agg(F.max(column)).scalar()
    return df.filter(keep(newest if isinstance(newest, Column) else F.lit(newest)))
