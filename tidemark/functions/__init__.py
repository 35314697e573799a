"""Column expressions shared by the operators (all built-in, JVM-side)."""

from tidemark.functions.columns import (
    as_date, as_month, month_of, movement_category, next_month, pct_change, prior_month,
    ratio, zero_money,
)

__all__ = [
    "as_date", "as_month", "month_of", "movement_category", "next_month", "pct_change",
    "prior_month", "ratio", "zero_money",
]
