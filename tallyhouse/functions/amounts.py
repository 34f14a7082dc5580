"""Money and ratio expressions.

Amounts stay DECIMAL through every sum, so totals do not depend on the order in which partitions
are merged. Only ratios leave DECIMAL, and only after both sums are final.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE; NULL when the denominator is 0 or NULL (ANSI division would throw)."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio(numerator: Column, denominator: Column, digits: int, scale: int = 1) -> Column:
    """Rounded ``scale * numerator / denominator``; give it sums, never averages of row ratios."""
    return F.round(F.lit(float(scale)) * safe_ratio(numerator, denominator), digits)


def money(amount: Column, digits: int = 2) -> Column:
    """Amount rounded half-up while it is still DECIMAL."""
    return F.round(amount, digits)


def _times_quantity(price: str) -> Column:
    """A quantity below ten million times a price of ten digits stays within 18 digits, so in a long."""
    return F.col("quantity").cast("decimal(7,0)") * F.col(price)


def line_revenue() -> Column:
    """``unit_price`` is already net of discount, so the discount is not subtracted again."""
    return _times_quantity("unit_price")


def line_cost() -> Column:
    return _times_quantity("unit_cost")


def line_profit() -> Column:
    return (line_revenue() - line_cost()).cast("decimal(18,4)")
