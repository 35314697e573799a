"""Scalar column expressions: months, money, ratios and the movement category."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import schemas as S


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value) -> Column:
    """A date column from a Column, a ``date`` or an ISO ``yyyy-MM-dd`` string."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, dt.date):
        return F.lit(value)
    return F.to_date(F.lit(str(value)))


def month_of(c) -> Column:
    """First day of the month of a date (``date_trunc('month', d)::date``)."""
    return F.trunc(_col(c), "month")


def as_month(value) -> Column:
    """First day of the month of a Column or literal date."""
    return month_of(as_date(value))


def next_month(c) -> Column:
    return F.add_months(_col(c), 1)


def prior_month(c) -> Column:
    return F.add_months(_col(c), -1)


def zero_money() -> Column:
    return F.lit(0).cast(S.MONEY)


def movement_category(current, prev, month, first_month) -> Column:
    """Classify one month's movement; the order of the tests is the semantics.

    Equality wins first (0 -> 0 and same-price plan swaps are No Change);
    a rise from zero is New only in the customer's first month.
    """
    cur, prv, m, fm = _col(current), _col(prev), _col(month), _col(first_month)
    return (
        F.when(cur == prv, F.lit(S.NO_CHANGE))
        .when((prv == 0) & (cur > 0), F.when(m == fm, F.lit(S.NEW)).otherwise(F.lit(S.REACTIVATION)))
        .when((prv > 0) & (cur > prv), F.lit(S.EXPANSION))
        .when((prv > 0) & (cur < prv) & (cur > 0), F.lit(S.CONTRACTION))
        .when((prv > 0) & (cur == 0), F.lit(S.CHURN))
        .otherwise(F.lit(S.INACTIVE))
    )


def ratio(numerator, denominator, default: float = 0.0, scale: float = 1.0) -> Column:
    """``numerator / denominator * scale`` in double, ``default`` unless denominator > 0."""
    num, den = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(den > 0, num / den * F.lit(scale)).otherwise(F.lit(default))


def pct_change(current, previous) -> Column:
    """Percent change, 0 when the previous value is not positive."""
    cur, prv = _col(current).cast("double"), _col(previous).cast("double")
    return F.when(prv > 0, (cur - prv) / prv * F.lit(100.0)).otherwise(F.lit(0.0))
