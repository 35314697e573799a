"""Monthly rollups straight from segment rows, without the dense ledger.

Inside a segment every month after the first is "No Change" with a zero
change, so every non-zero movement sits on a month-close row. Category sums
are therefore sums over month-close rows; ending MRR, active customers and
ledger rows are running sums of the per-month net change, of the change of
the active flag and of customers starting that month. The work is one pass
over month-close rows plus a running sum over (group, month) rows -- at most
months x groups rows -- instead of a pass over customers x months rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.columns import movement_category, zero_money
from tidemark.operators.movement import _one_month, last_month, segments
from tidemark.plans.checks import WATERFALL_ALIASES


def monthly_rollup(events: DataFrame, customers: DataFrame | None = None, by: list[str] | tuple = (),
                   bounds_events: DataFrame | None = None, partitions: int | None = None,
                   end: Column | None = None) -> DataFrame:
    """Per month (and per ``by`` customer attributes): starting/ending MRR, the
    five category sums, active customers and ledger rows; identical to the
    same rollup of ``movements(...)``. ``by`` should be low-cardinality. ``end`` as in ``segments``."""
    by = list(by)
    if by and customers is None:
        raise ValueError("`by` names customer attributes: pass `customers`")
    if end is None:
        end = last_month(bounds_events if bounds_events is not None else events)
    seg = segments(events, customers, attributes=by if customers is not None else None,
                   partitions=partitions, end=end)
    prior = F.coalesce(F.col("prior_mrr"), zero_money())
    cur = F.col("current_mrr")
    change = cur - prior
    cat = movement_category(cur, prior, F.col("month_date"), F.col("first_month"))
    flag = lambda c: F.when(c > 0, F.lit(1)).otherwise(F.lit(0))
    sparse = seg.groupBy("month_date", *by).agg(
        F.sum(change).alias("_net"),
        *[F.sum(F.when(cat == name, change).otherwise(zero_money())).alias(alias)
          for name, alias in zip(S.WATERFALL_CATEGORIES, WATERFALL_ALIASES)],
        F.sum(flag(cur) - flag(prior)).alias("_dactive"),
        F.sum(F.when(F.col("month_date") == F.col("first_month"), F.lit(1)).otherwise(F.lit(0))).alias("_dnew"),
    )
    # Every month from a group's first month to the global last month exists in
    # the dense ledger, with or without movements. Each (month, group) row of
    # deltas covers the months up to the group's next row (or the global last
    # month), the same way a month-close row covers its segment; only the first
    # month of such a span carries the deltas. At most #months rows per group.
    by_month = Window.partitionBy(*by).orderBy("month_date")
    spans = sparse.select(
        "*", F.coalesce(F.add_months(F.lead("month_date").over(by_month), -1), end)
        .alias("_until"))
    filled = spans.select(
        *by, *[c for c in spans.columns if c.startswith("_") and c not in ("_until",)],
        *WATERFALL_ALIASES,
        F.posexplode(F.sequence("month_date", "_until", _one_month())).alias("_pos", "month_date"))
    first = F.col("_pos") == 0

    def on_first(c):
        return F.when(first, F.col(c)).otherwise(F.lit(0))

    run = Window.partitionBy(*by).orderBy("month_date").rowsBetween(Window.unboundedPreceding, 0)
    ending = F.sum(on_first("_net")).over(run)
    return filled.select(
        "month_date", *by,
        (ending - on_first("_net")).alias("starting_mrr"),
        ending.alias("ending_mrr"),
        *[on_first(a).alias(a) for a in WATERFALL_ALIASES],
        F.sum(on_first("_dactive")).over(run).alias("active_customers"),
        F.sum(on_first("_dnew")).over(run).alias("ledger_rows"),
    )
