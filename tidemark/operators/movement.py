"""The movement model: sparse events -> dense customer-by-month ledger.

Semantics (per customer, per month from the customer's first event month to
the month of the globally last event): the month's state is the last event
dated before the next month starts (ties broken by ``event_id`` descending,
as strings); a missing amount is 0, a missing plan stays NULL; the state is
compared with the previous month's and classified.

Plan, built for skewed customers:

1. ``month_close``: one row per (customer, month) that has events, picked with
   ``max(struct(event_date, event_id, ...))``. The aggregate runs partially on
   the map side, so a customer with a huge share of the events is already
   reduced to at most one row per month and map task before the shuffle.
2. ``segments``: one window per customer over the month-close rows (at most
   one row per month, so no customer can make this window large) gives the
   previous close (``lag``), the next close month (``lead``) and the first
   month. Each month-close row starts a segment that lasts until the month
   before the next close, or the global last month.
3. ``expand``: ``posexplode(sequence(start, end))``. The first month of a
   segment takes its previous values from the previous segment, later months
   from the segment itself, so no second window (and no second sort) is needed
   over the dense rows.

Two exchanges of the fact in total (the partial aggregate's, and an explicit
hash repartition of the month-close rows by customer that the customer join
and the window reuse), no cross join, no range join. The global month bounds
are an uncorrelated scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.columns import month_of, movement_category, zero_money


def _one_month():
    return F.expr("INTERVAL 1 MONTH")


def month_bounds(events: DataFrame) -> DataFrame:
    """M1: one row with the first and last event month (NULLs on empty input)."""
    return events.agg(
        month_of(F.min("event_date")).alias("first_month"),
        month_of(F.max("event_date")).alias("last_month"),
    )


def last_month(events: DataFrame) -> Column:
    """The global last event month as a scalar-subquery column."""
    return events.select(month_of(F.max("event_date")).alias("last_month")).scalar()


def month_spine(events: DataFrame) -> DataFrame:
    """M2: every month from the first to the last event month, inclusive."""
    return month_bounds(events).select(
        F.explode(F.sequence("first_month", "last_month", _one_month())).alias("month_date")
    )


def customer_range(events: DataFrame) -> DataFrame:
    """M3: first event month per customer (partial + final hash aggregate)."""
    return events.groupBy("customer_id").agg(
        month_of(F.min("event_date")).alias("first_month")
    )


def customer_months(events: DataFrame) -> DataFrame:
    """M4: the dense customer x month grid from each customer's first month to the
    global last month, generated per customer instead of by a cross join."""
    return customer_range(events).select(
        "customer_id", "first_month",
        F.explode(F.sequence("first_month", last_month(events), _one_month())).alias("month_date"),
    )


def month_close(events: DataFrame) -> DataFrame:
    """Last event of each (customer, month) that has events: amount and plan."""
    last = F.max(F.struct("event_date", "event_id", "monthly_amount", "plan_id"))
    return (
        events.groupBy("customer_id", month_of("event_date").alias("month_date"))
        .agg(last.alias("_close"))
        .select(
            "customer_id", "month_date",
            F.coalesce(F.col("_close.monthly_amount"), zero_money()).alias("current_mrr"),
            F.col("_close.plan_id").alias("current_plan_id"),
        )
    )


def segments(events: DataFrame, customers: DataFrame | None = None,
             attributes: list[str] | None = None, bounds_events: DataFrame | None = None,
             partitions: int | None = None, end: Column | None = None) -> DataFrame:
    """Month-close rows with the previous close, the segment end and the first month.

    ``customers`` (optional) is inner-joined here, before any dense row exists,
    carrying ``attributes``; filtering it restricts the model to those customers
    while the global last month still comes from ``bounds_events`` (default:
    ``events``), as a filter applied after the model would. ``end`` gives that
    month itself (e.g. from file statistics), and no events are read for it. ``partitions``
    (default: ``spark.sql.shuffle.partitions``) sets the parallelism of the
    stage that builds the dense rows; size it by the ledger, not the events.
    """
    # The stage after this exchange multiplies rows (up to #months per segment),
    # so its parallelism must follow the session's partition count rather than
    # the (small) size of the month-close rows: an explicit count is not
    # coalesced by AQE. The customer join and the window reuse this partitioning.
    n = partitions or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if end is None:
        end = last_month(bounds_events if bounds_events is not None else events)
    return close_segments(month_close(events).repartition(n, "customer_id"), end, customers, attributes)


def close_segments(close: DataFrame, end: Column, customers: DataFrame | None = None,
                   attributes: list[str] | None = None) -> DataFrame:
    """``segments`` from month-close rows that are partitioned by customer already: by an
    exchange, or by how they are stored (``sources.clustered``), where none is needed
    here, nor for customers stored in the same buckets."""
    if customers is not None:
        attrs = list(attributes if attributes is not None else S.CUSTOMER_ATTRIBUTES)
        close = close.join(customers.select("customer_id", *attrs), "customer_id", "inner")
    w = Window.partitionBy("customer_id").orderBy("month_date")
    return close.select(
        "*",
        F.lag("current_mrr").over(w).alias("prior_mrr"),
        F.lag("current_plan_id").over(w).alias("prior_plan_id"),
        F.min("month_date").over(w).alias("first_month"),
        F.coalesce(F.add_months(F.lead("month_date").over(w), -1), end).alias("segment_end"),
    )


def with_plan_names(seg: DataFrame, plans: DataFrame) -> DataFrame:
    """Attach current and prior plan names to segment rows (dimension in two roles)."""
    names = plans.select("plan_id", "plan_name")
    cur = names.select(F.col("plan_id").alias("current_plan_id"),
                       F.col("plan_name").alias("current_plan_name"))
    pri = names.select(F.col("plan_id").alias("prior_plan_id"),
                       F.col("plan_name").alias("prior_plan_name"))
    return seg.join(cur, "current_plan_id", "left").join(pri, "prior_plan_id", "left")


def cut_by_year(seg: DataFrame, partitions: int | None = None) -> DataFrame:
    """Segments cut where a year ends and brought together by year; `expand` makes the same rows of them.

    A piece that does not open its segment has the segment's own values as its prior
    ones. Pieces are several times fewer than dense rows, so a ledger that is stored by
    month is shuffled before it is dense; a task then holds the months of few years.
    ``partitions`` sets the shuffle's initial count; AQE splits a large year by its size."""
    opening = F.col("year") == F.year("month_date")
    changed = {
        "month_date": F.when(opening, F.col("month_date")).otherwise(F.make_date("year", F.lit(1), F.lit(1))),
        "segment_end": F.least("segment_end", F.make_date("year", F.lit(12), F.lit(1))),
        **{c: F.when(opening, F.col(c)).otherwise(F.col(c.replace("prior_", "current_"))) for c in seg.columns if c.startswith("prior_")},
    }
    # prior_mrr stands for current_mrr, which the month's close never leaves missing
    pieces = seg.select("*", F.explode(F.sequence(F.year("month_date"), F.year("segment_end"))).alias("year"))
    pieces = pieces.select("year", *[changed.get(c, F.col(c)).alias(c) for c in seg.columns])
    return pieces.hint("rebalance", *([partitions] if partitions else []), "year").drop("year")


def expand(seg: DataFrame) -> DataFrame:
    """Dense rows from segment rows: month_date, prev_mrr, prev_plan_id (and
    prev_plan_name when present), mrr_change and mrr_category."""
    carry = [c for c in seg.columns if c not in ("month_date", "segment_end")]
    rows = seg.select(
        *carry,
        F.posexplode(F.sequence("month_date", "segment_end", _one_month())).alias("_pos", "month_date"),
    )
    opening = F.col("_pos") == 0
    out = rows.select(
        *[c for c in carry if not c.startswith("prior_")],
        "month_date",
        F.when(opening, F.coalesce("prior_mrr", zero_money())).otherwise(F.col("current_mrr"))
        .alias("prev_mrr"),
        F.when(opening, F.col("prior_plan_id")).otherwise(F.col("current_plan_id"))
        .alias("prev_plan_id"),
        *([F.when(opening, F.col("prior_plan_name")).otherwise(F.col("current_plan_name"))
           .alias("prev_plan_name")] if "prior_plan_name" in carry else []),
    )
    return out.select(
        "*",
        (F.col("current_mrr") - F.col("prev_mrr")).alias("mrr_change"),
        movement_category("current_mrr", "prev_mrr", "month_date", "first_month").alias("mrr_category"),
    )


def monthly_state(events: DataFrame) -> DataFrame:
    """M5-M7: month-end amount and plan per customer-month, carried forward."""
    return expand(segments(events)).select(
        "customer_id", "first_month", "month_date", "current_mrr", "current_plan_id")


def month_over_month(events: DataFrame) -> DataFrame:
    """M8-M9: monthly state with the previous month's amount (default 0) and plan."""
    return expand(segments(events)).select(
        "customer_id", "first_month", "month_date", "current_mrr", "current_plan_id",
        "prev_mrr", "prev_plan_id")


def classified_movements(events: DataFrame) -> DataFrame:
    """Change and category per customer-month."""
    return expand(segments(events)).select(
        "customer_id", "month_date", "current_mrr", "prev_mrr", "current_plan_id",
        "prev_plan_id", "mrr_change", "mrr_category")


def movements(events: DataFrame, customers: DataFrame, plans: DataFrame,
              bounds_events: DataFrame | None = None, partitions: int | None = None,
              end: Column | None = None, by_year: bool = False) -> DataFrame:
    """The full ledger, enriched with customer attributes (inner join)
    and prior/current plan names (left joins), in the model's column order.
    ``by_year``: the rows of a year in few tasks, to be stored by month (``cut_by_year``)."""
    seg = with_plan_names(segments(events, customers, bounds_events=bounds_events, partitions=partitions, end=end),
                          plans)
    return expand(cut_by_year(seg, partitions) if by_year else seg).select(*S.MOVEMENT_COLUMNS)


def movements_of_closes(closes: DataFrame, customers: DataFrame, plans: DataFrame, end: Column | None = None,
                        by_year: bool = False, partitions: int | None = None) -> DataFrame:
    """M7-M15 from month-close rows (``month_close``): the same ledger. Where ``closes`` and
    ``customers`` are stored in the same buckets by customer, nothing is shuffled below the window."""
    last = end if end is not None else closes.select(F.max("month_date")).scalar()
    seg = with_plan_names(close_segments(closes, last, customers), plans)
    return expand(cut_by_year(seg, partitions) if by_year else seg).select(*S.MOVEMENT_COLUMNS)


# ------------------------------------------------- composable step-by-step form
# For callers holding their own dense monthly state: the same semantics as
# ``movements`` applied step by step. Each window is per customer over at most
# one row per month, so no customer can make it large.

def with_prior_month(state: DataFrame) -> DataFrame:
    """M8-M9 over a dense state (customer_id, month_date, current_mrr,
    current_plan_id): previous month's amount (default 0) and plan."""
    w = Window.partitionBy("customer_id").orderBy("month_date")
    return state.select(
        "*",
        F.coalesce(F.lag("current_mrr").over(w), zero_money()).alias("prev_mrr"),
        F.lag("current_plan_id").over(w).alias("prev_plan_id"),
    )


def classify(mom: DataFrame) -> DataFrame:
    """Change and category; ``first_month`` is taken from the input if
    present, else computed per customer."""
    if "first_month" not in mom.columns:
        mom = mom.withColumn("first_month", F.min("month_date").over(Window.partitionBy("customer_id")))
    return mom.select(
        "*",
        (F.col("current_mrr") - F.col("prev_mrr")).alias("mrr_change"),
        movement_category("current_mrr", "prev_mrr", "month_date", "first_month").alias("mrr_category"),
    )


def enrich(classified: DataFrame, customers: DataFrame, plans: DataFrame) -> DataFrame:
    """Customer attributes (inner join) and plan names in two roles
    (left joins; AQE broadcasts the plans if they turn out small)."""
    names = plans.select("plan_id", "plan_name")
    out = (
        classified.join(customers.select("customer_id", *S.CUSTOMER_ATTRIBUTES), "customer_id", "inner")
        .join(names.select(F.col("plan_id").alias("prev_plan_id"), F.col("plan_name").alias("prev_plan_name")),
              "prev_plan_id", "left")
        .join(names.select(F.col("plan_id").alias("current_plan_id"),
                           F.col("plan_name").alias("current_plan_name")), "current_plan_id", "left")
    )
    return out.select(*S.MOVEMENT_COLUMNS)


def category_counts(ledger: DataFrame) -> DataFrame:
    """Rows per movement category."""
    return ledger.groupBy("mrr_category").agg(F.count(F.lit(1)).alias("n_rows"))
