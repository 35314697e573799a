"""KPIs, waterfall, trend, growth, segments, ledger.

All monthly outputs have one row per month (or per month and segment), so
the few unpartitioned windows below run over at most a few hundred rows.
Functions that take ``ledger`` accept any DataFrame with the ledger columns
they read: the dense ``movements`` output, an ``asof_snapshot`` or a
stand-in table. ``from_rollup`` variants take ``monthly_rollup`` output and
never touch customer-level rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.functions.columns import as_month, pct_change, prior_month, ratio
from tidemark.operators.movement import month_spine
from tidemark.plans.checks import WATERFALL_ALIASES

KPI_COLUMNS = [
    "month_date", "ending_mrr", "starting_mrr", "active_customers", "arpu", "nrr", "gross_churn",
    *WATERFALL_ALIASES,
]


# ---------------------------------------------------------------- filters (F*)

def filter_options(ledger: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Distinct values of a column, sorted."""
    values = ledger.select(column).distinct()
    return values.orderBy(F.col(column).desc() if descending else F.col(column).asc())


def customer_options(customers: DataFrame, events: DataFrame, column: str) -> DataFrame:
    """F1/F2 without the ledger: values of ``column`` among customers that have
    events (the ledger's customers), sorted. Event keys are de-duplicated with
    partial aggregation before the semi join."""
    with_events = events.select("customer_id").distinct()
    return filter_options(customers.join(with_events, "customer_id", "left_semi"), column)


def month_options(events: DataFrame) -> DataFrame:
    """F3 without the ledger: every month of the spine, newest first."""
    return month_spine(events).orderBy(F.col("month_date").desc())


def segment_filter(df: DataFrame, countries: list[str] | None = None,
                   industries: list[str] | None = None) -> DataFrame:
    """country IN list AND industry IN list; an empty list means no filter."""
    if countries:
        df = df.where(F.col("country").isin(list(countries)))
    if industries:
        df = df.where(F.col("industry").isin(list(industries)))
    return df


def at_month(ledger: DataFrame, month) -> DataFrame:
    """rows of one reporting month."""
    return ledger.where(F.col("month_date") == as_month(month))


def at_prior_month(ledger: DataFrame, month) -> DataFrame:
    """rows of the calendar month before ``month``."""
    return ledger.where(F.col("month_date") == prior_month(as_month(month)))


def active_rows(ledger: DataFrame) -> DataFrame:
    """F8: rows with positive current MRR."""
    return ledger.where(F.col("current_mrr") > 0)


def active_movements(ledger: DataFrame) -> DataFrame:
    """drop quiet rows (No Change, Inactive)."""
    return ledger.where(~F.col("mrr_category").isin(S.QUIET_CATEGORIES))


def search_name(df: DataFrame, pattern: str | None, column: str = "customer_name") -> DataFrame:
    """case-insensitive regular-expression search, also beyond ASCII (Java regex dialect);
    NULL names never match; an empty pattern means no filter."""
    if not pattern:
        return df
    return df.where(F.col(column).rlike("(?iu)" + pattern))


# ------------------------------------------------------------------- KPIs (K*)

def _with_ratios(df: DataFrame) -> DataFrame:
    retained = F.col("starting_mrr") + sum(F.col(a) for a in WATERFALL_ALIASES[1:])
    losses = F.abs(F.col("contraction_mrr") + F.col("churn_mrr"))
    return df.select(
        "*",
        ratio("ending_mrr", "active_customers").alias("arpu"),
        ratio(retained, "starting_mrr", default=100.0, scale=100.0).alias("nrr"),
        ratio(losses, "starting_mrr", default=0.0, scale=100.0).alias("gross_churn"),
    ).select(*KPI_COLUMNS)


def _sum_when(cond: Column, value: str) -> Column:
    return F.sum(F.when(cond, F.col(value)).otherwise(F.lit(0)))


def monthly_kpis(ledger: DataFrame) -> DataFrame:
    """K1-K11 for every month of a ledger-shaped DataFrame. Active customers are
    counted as rows with positive MRR: (customer, month) is unique in the model,
    so this equals the distinct count without its extra aggregation."""
    cat = F.col("mrr_category")
    sums = ledger.groupBy("month_date").agg(
        F.sum("current_mrr").alias("ending_mrr"),
        F.sum("prev_mrr").alias("starting_mrr"),
        F.sum(F.when(F.col("current_mrr") > 0, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
        .alias("active_customers"),
        *[_sum_when(cat == name, "mrr_change").alias(alias)
          for name, alias in zip(S.WATERFALL_CATEGORIES, WATERFALL_ALIASES)],
    )
    return _with_ratios(sums)


def kpis_from_rollup(rollup: DataFrame) -> DataFrame:
    """K1-K11 from ``monthly_rollup`` output (fast path)."""
    return _with_ratios(rollup.select(
        "month_date", "ending_mrr", "starting_mrr", F.col("active_customers").cast("bigint"),
        *WATERFALL_ALIASES))


def _defaults() -> dict[str, Column]:
    zero = F.lit(0).cast("decimal(10,2)")
    out = {"ending_mrr": zero, "starting_mrr": zero, "active_customers": F.lit(0).cast("bigint"),
           "arpu": F.lit(0.0), "nrr": F.lit(100.0), "gross_churn": F.lit(0.0)}
    out.update({a: zero for a in WATERFALL_ALIASES})
    return out


def kpis_at(kpis: DataFrame, month) -> DataFrame:
    """K12 (+F6): the KPI row of one month; a month without rows gets the
    defaults (all zero, NRR 100) instead of vanishing."""
    return kpis_over(kpis, kpis.sparkSession.range(1).select(as_month(month).alias("month_date")))


def kpis_over(kpis: DataFrame, months: DataFrame) -> DataFrame:
    """K12 for every row of ``months`` (month_date), e.g. ``month_spine(events)``: a
    segment's months before its first customer get the defaults."""
    d = _defaults()
    return months.join(kpis, "month_date", "left").select(
        "month_date", *[F.coalesce(F.col(c), d[c]).alias(c) for c in KPI_COLUMNS[1:]])


def kpi_deltas(kpis: DataFrame) -> DataFrame:
    """K13-K18 for every month: change against the previous calendar month's
    KPIs, where a missing previous month counts with the defaults. One ordered
    pass over the KPI rows (one per month) instead of a self-join, so the KPI
    table is computed once."""
    by_month = Window.orderBy("month_date")  # one row per month
    prior = F.lag("month_date").over(by_month) == F.add_months("month_date", -1)

    def prev(c, default):
        return F.when(prior, F.lag(c).over(by_month)).otherwise(F.lit(default))

    j = kpis.select(
        "*",
        prev("ending_mrr", 0).alias("p_ending_mrr"),
        prev("active_customers", 0).alias("p_active_customers"),
        prev("arpu", 0.0).alias("p_arpu"),
        prev("nrr", 100.0).alias("p_nrr"),
        prev("gross_churn", 0.0).alias("p_gross_churn"),
    )
    return j.select(
        "month_date", "ending_mrr",
        pct_change("ending_mrr", "p_ending_mrr").alias("delta_mrr_pct"),
        "active_customers",
        (F.col("active_customers") - F.col("p_active_customers")).alias("delta_customers"),
        "arpu",
        pct_change("arpu", "p_arpu").alias("delta_arpu_pct"),
        "nrr",
        (F.col("nrr") - F.col("p_nrr")).alias("delta_nrr"),
        "gross_churn",
        (F.col("gross_churn") - F.col("p_gross_churn")).alias("delta_churn"),
        (F.col("p_ending_mrr") > 0).alias("has_prior"),
    )


# ------------------------------------------------------------ reports (R*)

# Waterfall steps (label, measure) in display order.
WATERFALL_STEPS = [
    ("Starting MRR", "absolute", "starting_mrr"),
    ("New MRR", "relative", "new_mrr"),
    ("Expansion", "relative", "expansion_mrr"),
    ("Reactivation", "relative", "reactivation_mrr"),
    ("Contraction", "relative", "contraction_mrr"),
    ("Churn", "relative", "churn_mrr"),
    ("Ending MRR", "total", "ending_mrr"),
]


def waterfall_steps(kpi_row: DataFrame) -> DataFrame:
    """Seven ordered steps (step_order, step, measure, amount) per KPI row."""
    steps = F.array(*[
        F.struct(F.lit(i + 1).alias("step_order"), F.lit(label).alias("step"),
                 F.lit(measure).alias("measure"), F.col(col).cast("decimal(38,2)").alias("amount"))
        for i, (label, measure, col) in enumerate(WATERFALL_STEPS)])
    return kpi_row.select("month_date", F.inline(steps))


def waterfall_equation(kpi_row: DataFrame) -> DataFrame:
    """R2: start + increases - decreases = end."""
    return kpi_row.select(
        "month_date", "starting_mrr",
        (F.col("new_mrr") + F.col("expansion_mrr") + F.col("reactivation_mrr")).alias("total_increases"),
        F.abs(F.col("contraction_mrr") + F.col("churn_mrr")).alias("total_decreases"),
        "ending_mrr",
    )


def trend(ledger: DataFrame) -> DataFrame:
    """R3 (+F8): ending MRR and active customers per month present in the input."""
    return ledger.groupBy("month_date").agg(
        F.sum("current_mrr").alias("ending_mrr"),
        F.sum(F.when(F.col("current_mrr") > 0, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
        .alias("active_customers"),
    )


def trend_from_rollup(rollup: DataFrame) -> DataFrame:
    """R3 from ``monthly_rollup`` output."""
    return rollup.select("month_date", "ending_mrr", F.col("active_customers").cast("bigint"))


def growth(trend_df: DataFrame) -> DataFrame:
    """Growth and CAGR of MRR and active customers from the first to the
    last month of a trend; all 0 with fewer than two months or a non-positive
    start (CAGR also needs a positive end)."""
    s = trend_df.agg(
        F.count(F.lit(1)).alias("n_months"),
        F.min_by("ending_mrr", "month_date").cast("double").alias("first_mrr"),
        F.max_by("ending_mrr", "month_date").cast("double").alias("last_mrr"),
        F.min_by("active_customers", "month_date").cast("double").alias("first_customers"),
        F.max_by("active_customers", "month_date").cast("double").alias("last_customers"),
    )
    many = F.col("n_months") > 1
    years = (F.col("n_months") - 1) / F.lit(12.0)

    def grow(first, last):
        return F.when(many & (F.col(first) > 0),
                      (F.col(last) - F.col(first)) / F.col(first) * 100.0).otherwise(F.lit(0.0))

    def cagr(first, last):
        return F.when(many & (F.col(first) > 0) & (F.col(last) > 0),
                      (F.pow(F.col(last) / F.col(first), F.lit(1.0) / years) - 1.0) * 100.0
                      ).otherwise(F.lit(0.0))

    return s.select(
        "n_months",
        grow("first_mrr", "last_mrr").alias("mrr_growth_pct"),
        grow("first_customers", "last_customers").alias("customer_growth_pct"),
        cagr("first_mrr", "last_mrr").alias("mrr_cagr"),
        cagr("first_customers", "last_customers").alias("customer_cagr"),
    )


def segment_mix(ledger: DataFrame, month, by: str = "company_size") -> DataFrame:
    """Active MRR by segment for one month."""
    rows = active_rows(at_month(ledger, month))
    return rows.groupBy(by).agg(F.sum("current_mrr").alias("mrr_contribution"))


# Activity-ledger output columns (source -> label).
LEDGER_COLUMNS = [
    ("customer_name", "customer_name"),
    ("country", "country"),
    ("industry", "industry"),
    ("company_size", "segment"),
    ("prev_plan_name", "previous_plan"),
    ("current_plan_name", "new_plan"),
    ("mrr_change", "mrr_change"),
    ("mrr_category", "action_category"),
]


# The activity ledger's display labels, in column order.
LEDGER_DISPLAY_LABELS = ["Customer Name", "Country", "Industry", "Segment", "Previous Plan", "New Plan",
                         "Monthly MRR Change", "Action Category"]


def activity_ledger(ledger: DataFrame, month, pattern: str | None = None,
                    display_labels: bool = False) -> DataFrame:
    """R9 (+F6, F9, F10): one month's non-quiet rows, projected and renamed
    (snake_case names, or the report's display labels)."""
    rows = search_name(active_movements(at_month(ledger, month)), pattern)
    names = LEDGER_DISPLAY_LABELS if display_labels else [dst for _, dst in LEDGER_COLUMNS]
    return rows.select(*[F.col(src).alias(dst) for (src, _), dst in zip(LEDGER_COLUMNS, names)])


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """A one-row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def month_report(events: DataFrame, customers: DataFrame, month, countries: list[str] | None = None,
                 industries: list[str] | None = None) -> DataFrame:
    """K1-K18 for one reporting month under the segment filters (F4/F5): the
    month's KPIs with their change against the previous calendar month, from
    the movement-only rollup (no dense ledger). Always one row: without customers
    in the filter, or before the first of them, with the defaults. The global last month stays
    that of all events, as when the filter is applied after the model."""
    from tidemark.operators.rollup import monthly_rollup

    kept = segment_filter(customers, countries, industries)
    kpis = kpis_from_rollup(monthly_rollup(events, kept, bounds_events=events))
    two = kpis.sparkSession.range(2).select(F.add_months(as_month(month), -F.col("id").cast("int")).alias("month_date"))
    return kpi_deltas(kpis_over(kpis, two)).where(F.col("month_date") == as_month(month))
