"""Column expressions shared by the operators."""

from tallyhouse.functions.amounts import line_cost, line_profit, line_revenue, money, ratio, safe_ratio
from tallyhouse.functions.dates import month_of, period_end, period_index, period_start, quarter_of

__all__ = [
    "line_cost", "line_profit", "line_revenue", "money", "ratio", "safe_ratio",
    "month_of", "period_end", "period_index", "period_start", "quarter_of",
]
