"""As-of snapshot: the ledger rows of one month without building the history.

For a month m only two states per customer matter: the last event before
m + 1 month (this month's close) and the last event before m (last month's
close). Both come out of one grouped aggregate over the events dated before
m + 1 month -- a filter that reaches the parquet scan when ``event_date`` is
a stored date column -- with partial aggregation before the shuffle, so a
hot customer is reduced on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.columns import as_month, month_of, movement_category, zero_money
from tidemark.operators.movement import last_month


def asof_snapshot(events: DataFrame, month, customers: DataFrame | None = None,
                  plans: DataFrame | None = None, bounds_events: DataFrame | None = None,
                  end: Column | None = None) -> DataFrame:
    """Rows equal to ``movements(...)`` restricted to ``month_date = month``. ``end``: the global
    last month, where it is known; else the events are read for it."""
    m = as_month(month)
    if end is None:
        end = last_month(bounds_events if bounds_events is not None else events)
    rec = F.struct("event_date", "event_id", "monthly_amount", "plan_id")
    upto = events.where(F.col("event_date") < F.add_months(m, 1))
    per = upto.groupBy("customer_id").agg(
        F.max(rec).alias("_cur"),
        F.max(F.when(F.col("event_date") < m, rec)).alias("_prev"),
        month_of(F.min("event_date")).alias("first_month"),
    ).where(m <= end)
    had_prior = F.col("first_month") < m
    rows = per.select(
        "customer_id", "first_month", m.alias("month_date"),
        F.when(had_prior, F.coalesce(F.col("_prev.monthly_amount"), zero_money()))
        .otherwise(zero_money()).alias("prev_mrr"),
        F.coalesce(F.col("_cur.monthly_amount"), zero_money()).alias("current_mrr"),
        F.when(had_prior, F.col("_prev.plan_id")).alias("prev_plan_id"),
        F.col("_cur.plan_id").alias("current_plan_id"),
    )
    rows = rows.select(
        "*",
        (F.col("current_mrr") - F.col("prev_mrr")).alias("mrr_change"),
        movement_category("current_mrr", "prev_mrr", "month_date", "first_month").alias("mrr_category"),
    )
    if customers is not None:
        rows = rows.join(customers.select("customer_id", *S.CUSTOMER_ATTRIBUTES), "customer_id", "inner")
    if plans is not None:
        names = plans.select("plan_id", "plan_name")
        rows = (
            rows.join(names.select(F.col("plan_id").alias("current_plan_id"),
                                   F.col("plan_name").alias("current_plan_name")), "current_plan_id", "left")
            .join(names.select(F.col("plan_id").alias("prev_plan_id"),
                               F.col("plan_name").alias("prev_plan_name")), "prev_plan_id", "left")
        )
    if customers is not None and plans is not None:
        return rows.select(*S.MOVEMENT_COLUMNS)
    return rows
