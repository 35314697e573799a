"""

Every query reads the driver's tables (orders, customer, nation) through
``tidemark.sources.fixture`` -- the whole tables, no sampling -- and runs the
library's operators. Money columns are cast to DOUBLE and ratios rounded to
6 places at the very end so that the DuckDB oracles (``oracles.py``) compare
value for value; the library itself keeps decimals throughout.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracles  # noqa: E402
from tidemark import schemas as S  # noqa: E402
from tidemark.operators import movement as M  # noqa: E402
from tidemark.operators.asof import state_asof  # noqa: E402
from tidemark.operators.rollup import monthly_rollup  # noqa: E402
from tidemark.operators.snapshot import asof_snapshot  # noqa: E402
from tidemark.plans import checks as V  # noqa: E402
from tidemark.plans import jobs as J  # noqa: E402
from tidemark.plans import metrics as K  # noqa: E402
from tidemark.plans import quality as Q  # noqa: E402
from tidemark.plans import violations as W  # noqa: E402
from tidemark.plans.coverage import customer_coverage, customer_differences  # noqa: E402
from tidemark.plans.bound import select_where  # noqa: E402
from tidemark.plans.lifecycle import derive_event_type  # noqa: E402
from tidemark.session import checkpoint_dir  # noqa: E402
from tidemark.sources import fixture  # noqa: E402
from tidemark.sources import publish as P  # noqa: E402
from tidemark.sources.clustered import Clustering, read_clustered, write_clustered  # noqa: E402
from tidemark.sources.pages import page_rows, read_page  # noqa: E402
from tidemark.sources.publish import load_counts  # noqa: E402
from tidemark.sources.stats import MonthBounds, stored_range  # noqa: E402
from tidemark.sources.tables import conform, conform_counts, row_counts  # noqa: E402

try:
    from tidemark.llm.oracles import ORACLES as LLM_ORACLES
    from tidemark.llm.queries import QUERIES as LLM_QUERIES
except ImportError:  # the library works without its subpackage for training data
    LLM_QUERIES, LLM_ORACLES = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"

MONEY = {"prev_mrr", "current_mrr", "mrr_change", "starting_mrr", "ending_mrr", "new_mrr",
         "expansion_mrr", "reactivation_mrr", "contraction_mrr", "churn_mrr", "monthly_amount",
         "mrr_contribution", "total_increases", "total_decreases", "amount", "monthly_price"}
RATIOS = {"arpu", "nrr", "gross_churn", "delta_mrr_pct", "delta_arpu_pct", "delta_nrr", "delta_churn",
          "mrr_growth_pct", "customer_growth_pct", "mrr_cagr", "customer_cagr"}


def _out(df: DataFrame) -> DataFrame:
    """Comparison types: money as DOUBLE, ratios rounded to 6 places."""
    cols = []
    for name in df.columns:
        if name in MONEY:
            cols.append(F.col(name).cast("double").alias(name))
        elif name in RATIOS:
            cols.append(F.round(F.col(name).cast("double"), 6).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def _inputs(spark: SparkSession, sf: str):
    return fixture.plans(spark, sf), fixture.customers(spark, sf), fixture.model_events(spark, sf)


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    plans, customers, events = _inputs(spark, sf)
    return M.movements(events, customers, plans)


def _composed(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger built step by step (state -> prior month -> classify -> enrich)."""
    plans, customers, events = _inputs(spark, sf)
    return M.enrich(M.classify(M.with_prior_month(M.monthly_state(events))), customers, plans)


def _report_month(spark: SparkSession, sf: str):
    """The reporting month: the last complete month, i.e. the month before the
    last month with events (a scalar subquery over the events)."""
    return F.add_months(M.last_month(fixture.model_events(spark, sf)), -1)


def _rollup(spark: SparkSession, sf: str, segment: bool = False) -> DataFrame:
    _, customers, events = _inputs(spark, sf)
    if segment:
        customers = K.segment_filter(customers, oracles.COUNTRIES, oracles.INDUSTRIES)
    return monthly_rollup(events, customers, bounds_events=events)


def _kpis(spark: SparkSession, sf: str) -> DataFrame:
    return K.kpis_from_rollup(_rollup(spark, sf))


def _kpi_row(spark: SparkSession, sf: str) -> DataFrame:
    return K.kpis_at(_kpis(spark, sf), _report_month(spark, sf))


def _checks(spark: SparkSession, sf: str) -> DataFrame:
    plans, customers, _ = _inputs(spark, sf)
    return V.run_checks(_ledger(spark, sf), fixture.customers(spark, sf), plans)


def _activity(spark: SparkSession, sf: str, pattern: str | None = None) -> DataFrame:
    """One month's activity from the as-of snapshot: no dense history is built."""
    month = _report_month(spark, sf)
    plans, customers, events = _inputs(spark, sf)
    return K.activity_ledger(asof_snapshot(events, month, customers, plans), month, pattern)


def _snapshot(spark: SparkSession, sf: str, months_back: int = 0) -> DataFrame:
    plans, customers, events = _inputs(spark, sf)
    month = F.add_months(_report_month(spark, sf), -months_back)
    return asof_snapshot(events, month, customers, plans)


def _conform_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that conform to the declared schema and rows rejected, per table."""
    tables = {"plans": (fixture.plans(spark, sf), S.PLANS),
              "customers": (fixture.customers(spark, sf), S.CUSTOMERS),
              "events": (fixture.events(spark, sf), S.EVENTS)}
    return Q.union_all([conform_counts(df, schema).select(F.lit(name).alias("table_name"), "ok_rows",
                                                          "rejected_rows")
                        for name, (df, schema) in tables.items()])


def _load_counts(spark: SparkSession, sf: str) -> DataFrame:
    return row_counts({"plans": fixture.plans(spark, sf), "customers": fixture.customers(spark, sf),
                       "events": fixture.raw_events(spark, sf)})


def _load_check(spark: SparkSession, sf: str) -> DataFrame:
    """Rows handed to the load vs rows that survive conformance."""
    inputs = {"plans": (fixture.plans(spark, sf), S.PLANS),
              "customers": (fixture.customers(spark, sf), S.CUSTOMERS),
              "events": (fixture.events(spark, sf), S.EVENTS)}
    return load_counts({k: v[0] for k, v in inputs.items()},
                       {k: conform(v[0], v[1])[0] for k, v in inputs.items()})


def _quality(spark: SparkSession, sf: str, rules, events=fixture.raw_events) -> DataFrame:
    """Rules over the three inputs; `events` derives the event type only for rules that read it."""
    return Q.union_all(rules(fixture.plans(spark, sf), fixture.customers(spark, sf), events(spark, sf)))


def _broken(spark: SparkSession, sf: str):
    """A ledger whose June starting balances are off by one per row, and dimensions that lack
    customers and plans which the ledger has: every validator has something to find."""
    plans, customers, _ = _inputs(spark, sf)
    ledger = _ledger(spark, sf).withColumn("prev_mrr", F.when(
        F.month("month_date") == 6, (F.col("prev_mrr") + 1).cast(S.MONEY)).otherwise(F.col("prev_mrr")))
    return ledger, customers.where("industry = 'BUILDING'"), plans.where("monthly_price > 40")


def _broken_plans(spark: SparkSession, sf: str) -> DataFrame:
    """Plans as text, with prices that do not cast for two of them."""
    return fixture.plans(spark, sf).withColumn("monthly_price", F.when(
        F.col("plan_id").rlike("^[12]"), F.lit("n/a")).otherwise(F.col("monthly_price").cast("string")))


def _mislabelled(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose type follows from their plan instead of their order."""
    kinds = {"1": "signup", "2": "upgrade", "3": "downgrade", "4": "reactivate"}
    kind = F.lit("cancel")
    for digit, name in kinds.items():
        kind = F.when(F.col("plan_id").startswith(digit), F.lit(name)).otherwise(kind)
    return fixture.raw_events(spark, sf).withColumn("event_type", kind)


_PUBLISHED: dict[tuple[str, str], str] = {}


def _published(spark: SparkSession, sf: str) -> str:
    """Publish inputs and ledger as one version, and register the views over it; the
    base, published once per session and input folder."""
    known = spark.sparkContext.applicationId, sf
    if known not in _PUBLISHED:
        base = f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}"
        plans, customers, events = _inputs(spark, sf)
        events = events.withColumn("event_type", F.lit("signup")).select(*S.EVENTS.fieldNames())
        P.publish(
            spark, {"plans": plans, "customers": customers, "events": events}, base,
            checks=lambda t: Q.union_all([Q.check_unique(t["plans"], "plan_id", "plans.plan_id.unique"),
                                          Q.check_fk(t["events"], t["customers"], "customer_id", "customer_id", "fk")]),
            derived=lambda t: {J.LEDGER: lambda path: P.write_ledger(
                M.movements(t["events"], t["customers"], t["plans"], by_year=True), path, by_year=True)})
        _PUBLISHED[known] = base
    J.register(spark, _PUBLISHED[known])
    return _PUBLISHED[known]


def _stored(spark: SparkSession, sf: str, name: str) -> str:
    base = _published(spark, sf)
    return f"{base}/{P.current_version(spark, base)}/{name}"


def _clustered_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """M15 from month-close rows and customers stored in buckets by customer; the last month from the files' footers."""
    plans, customers, events = _inputs(spark, sf)
    base = f"{checkpoint_dir(spark).rstrip('/')}/clustered-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = Clustering("customer_id", n)
    write_clustered(M.month_close(events), f"{base}/closes", by)
    write_clustered(customers, f"{base}/customers", by)
    end = MonthBounds(spark, f"{base}/closes", "month_date").end()
    return M.movements_of_closes(read_clustered(spark, f"{base}/closes", by), read_clustered(spark, f"{base}/customers", by), plans, end)


def _published_month(spark: SparkSession, sf: str, pick) -> DataFrame:
    """F6/F7 on the stored ledger: the month is a subquery, and only its folder is read."""
    _published(spark, sf)
    return pick(spark.table("mrr_movements"), _report_month(spark, sf)).select(*S.MOVEMENT_COLUMNS)


def _defective(spark: SparkSession, sf: str):
    """Inputs that break every kind of rule: types outside the domain and missing, negative amounts, events loaded
    twice, customers and plans that are not there, sizes outside the domain."""
    plans, customers, events = _inputs(spark, sf)
    kind = F.when(F.col("plan_id").startswith("4"), "renewal").when(F.col("plan_id").startswith("3"), F.lit(None)).otherwise("signup")
    events = events.withColumn("event_type", kind).withColumn("monthly_amount", (F.col("monthly_amount") - 20).cast(S.MONEY))
    events = events.unionByName(events.where(F.col("event_id").endswith("7")))
    customers = customers.where("industry = 'BUILDING'").withColumn("company_size", F.replace("company_size", F.lit("SMB"), F.lit("Tiny")))
    return plans.where("monthly_price > 40"), customers, events


def _violating_events(spark: SparkSession, sf: str) -> DataFrame:
    plans, customers, events = _defective(spark, sf)
    rows = W.violating_rows(events, W.input_rules(plans, customers)["events"])
    return rows.select("event_id", F.array_join(W.BROKEN, ",").alias("broken_rules"))


PAGE_ORDER, PAGE_ROWS = ["country", "customer_name", "customer_id"], 50


def _client_page(spark: SparkSession, sf: str) -> DataFrame:
    """The second page of one month's activity, behind the position where the first one ends."""
    rows = K.active_movements(_snapshot(spark, sf)).select("customer_id", "customer_name", "country", "mrr_change", "mrr_category")
    first = read_page(rows, PAGE_ORDER, PAGE_ROWS)
    return page_rows(rows, PAGE_ORDER, PAGE_ROWS, first.after) if first.after else rows.where(F.lit(False))


def _bound_segment(spark: SparkSession, sf: str, search: str | None = None) -> DataFrame:
    """The stored ledger's view by bound SQL."""
    _published(spark, sf)
    return select_where(spark, "mrr_movements", S.MOVEMENT_COLUMNS, among={"country": oracles.COUNTRIES, "industry": oracles.INDUSTRIES},
                        like={"customer_name": search})


def _scan(spark: SparkSession, sf: str) -> DataFrame:
    """The stored ledger, read through its view."""
    _published(spark, sf)
    return spark.sql(f"SELECT {', '.join(S.MOVEMENT_COLUMNS)} FROM mrr_movements")


def _view_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every published view."""
    _published(spark, sf)
    views = ["dim_customers", "dim_plans", "mrr_movements", "subscription_events"]
    return row_counts({v: spark.table(v) for v in views})


def _month_end_state(spark: SparkSession, sf: str) -> DataFrame:
    """M5/M6 by the as-of join: each customer-month's last event before the next month."""
    events = fixture.model_events(spark, sf)
    grid = M.customer_months(events).withColumn("next_month", F.add_months("month_date", 1))
    state = state_asof(grid, events, "next_month", strict=True, bucket=lambda t: F.trunc(t, "quarter"))
    return state.select("customer_id", "first_month", "month_date", F.coalesce("monthly_amount", F.lit(0)).cast(S.MONEY).alias("current_mrr"),
                        F.col("plan_id").alias("current_plan_id"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # movement model
    "month_bounds": lambda s, d: M.month_bounds(fixture.model_events(s, d)),
    "month_spine": lambda s, d: M.month_spine(fixture.model_events(s, d)),
    "customer_range": lambda s, d: M.customer_range(fixture.model_events(s, d)),
    "customer_months": lambda s, d: M.customer_months(fixture.model_events(s, d)),
    "monthly_state": lambda s, d: _out(M.monthly_state(fixture.model_events(s, d))),
    "month_over_month": lambda s, d: _out(M.month_over_month(fixture.model_events(s, d))),
    "classified_movements": lambda s, d: _out(M.classified_movements(fixture.model_events(s, d))),
    "movements": lambda s, d: _out(_ledger(s, d)),
    "movements_composed": lambda s, d: _out(_composed(s, d)),
    "category_counts": lambda s, d: M.category_counts(_ledger(s, d)),
    # validators
    "monthly_waterfall": lambda s, d: _out(V.monthly_waterfall(_ledger(s, d))),
    "monthly_waterfall_fast": lambda s, d: _out(_rollup(s, d).select(
        "month_date", "starting_mrr", "ending_mrr", *V.WATERFALL_ALIASES)),
    "check_reconciliation": lambda s, d: V.check_reconciliation(_ledger(s, d)),
    "check_continuity": lambda s, d: V.check_continuity(_ledger(s, d)),
    "check_customer_counts": lambda s, d: V.check_customer_counts(fixture.customers(s, d), _ledger(s, d)),
    "check_orphan_customers": lambda s, d: V.check_orphan_customers(_ledger(s, d), fixture.customers(s, d)),
    "check_orphan_plans": lambda s, d: V.check_orphan_plans(_ledger(s, d), fixture.plans(s, d)),
    "check_integrity": lambda s, d: V.check_integrity(_ledger(s, d), fixture.customers(s, d),
                                                      fixture.plans(s, d)),
    "run_checks": _checks,
    "validation_report": lambda s, d: V.validation_report(_checks(s, d)),
    # KPIs and reports
    "monthly_kpis": lambda s, d: _out(_kpis(s, d)),
    "kpis_at_month": lambda s, d: _out(_kpi_row(s, d)),
    "kpis_prior_month": lambda s, d: _out(K.kpis_at(_kpis(s, d), F.add_months(_report_month(s, d), -1))),
    "kpis_filtered": lambda s, d: _out(K.kpis_from_rollup(_rollup(s, d, segment=True))),
    "month_report": lambda s, d: _out(K.month_report(
        fixture.model_events(s, d), fixture.customers(s, d), _report_month(s, d),
        oracles.COUNTRIES, oracles.INDUSTRIES)),
    "kpis_at_empty_month": lambda s, d: _out(K.kpis_at(_kpis(s, d), F.add_months(M.last_month(fixture.model_events(s, d)), 1))),
    "kpi_deltas": lambda s, d: _out(K.kpi_deltas(_kpis(s, d))),
    "waterfall_steps": lambda s, d: _out(K.waterfall_steps(_kpi_row(s, d))),
    "waterfall_equation": lambda s, d: _out(K.waterfall_equation(_kpi_row(s, d))),
    "trend": lambda s, d: _out(K.trend_from_rollup(_rollup(s, d))),
    "trend_filtered": lambda s, d: _out(K.trend_from_rollup(_rollup(s, d, segment=True))),
    "segment_trend": lambda s, d: _out(monthly_rollup(
        fixture.model_events(s, d), fixture.customers(s, d), by=["company_size"]).select(
        "month_date", "company_size", "ending_mrr", "starting_mrr", "churn_mrr",
        F.col("active_customers").cast("bigint"), F.col("ledger_rows").cast("bigint"))),
    "growth_cagr": lambda s, d: _out(K.growth(K.trend_from_rollup(_rollup(s, d)))),
    "segment_mix": lambda s, d: _out(K.segment_mix(
        asof_snapshot(fixture.model_events(s, d), _report_month(s, d), fixture.customers(s, d)),
        _report_month(s, d))),
    "activity_ledger": lambda s, d: _out(_activity(s, d)),
    "ledger_search": lambda s, d: _out(_activity(s, d, oracles.NAME_PATTERN)),
    "ledger_count": lambda s, d: K.row_count(_activity(s, d)),
    "segment_filter_count": lambda s, d: K.row_count(
        K.segment_filter(_ledger(s, d), oracles.COUNTRIES, oracles.INDUSTRIES)),
    "options_country": lambda s, d: K.customer_options(fixture.customers(s, d), fixture.model_events(s, d),
                                                       "country"),
    "options_industry": lambda s, d: K.customer_options(fixture.customers(s, d), fixture.model_events(s, d),
                                                        "industry"),
    "options_month": lambda s, d: K.month_options(fixture.model_events(s, d)),
    # sources
    "read_plans": lambda s, d: _out(conform(fixture.plans(s, d), S.PLANS)[0]),
    "read_customers": lambda s, d: conform(fixture.customers(s, d), S.CUSTOMERS)[0],
    "read_events": lambda s, d: _out(conform(fixture.events(s, d), S.EVENTS)[0]),
    "conform_rejects": _conform_summary,
    "load_check": _load_check,
    "load_counts": _load_counts,
    # lifecycle and data quality
    "derive_event_type": lambda s, d: derive_event_type(fixture.raw_events(s, d)).select(
        "event_id", "customer_id", "event_type"),
    "audit_lifecycle": lambda s, d: Q.reason_counts(Q.lifecycle_violations(fixture.events(s, d))),
    "audit_price": lambda s, d: Q.reason_counts(Q.price_violations(fixture.events(s, d), fixture.plans(s, d))),
    "check_unique_keys": lambda s, d: _quality(s, d, lambda p, c, e: [
        Q.check_unique(p, "plan_id", "plans.plan_id.unique"),
        Q.check_unique(c, "customer_id", "customers.customer_id.unique"),
        Q.check_unique(e, "event_id", "events.event_id.unique")]),
    "check_not_null": lambda s, d: _quality(s, d, lambda p, c, e: [
        Q.check_not_null(p, S.NOT_NULL["plans"], "plans"),
        Q.check_not_null(c, S.NOT_NULL["customers"], "customers"),
        Q.check_not_null(e, S.NOT_NULL["events"], "events")], fixture.events),
    "check_domains": lambda s, d: _quality(s, d, lambda p, c, e: [
        Q.check_domain(p, "billing_cycle", S.BILLING_CYCLES, "plans.billing_cycle.domain"),
        Q.check_domain(c, "company_size", S.COMPANY_SIZES, "customers.company_size.domain"),
        Q.check_domain(e, "event_type", S.EVENT_TYPES, "events.event_type.domain"),
        Q.check_min(e, "monthly_amount", 0, "events.monthly_amount.min")], fixture.events),
    "check_foreign_keys": lambda s, d: _quality(s, d, lambda p, c, e: [
        Q.check_fk(e, c, "customer_id", "customer_id", "events.customer_id.fk"),
        Q.check_fk(e, p, "plan_id", "plan_id", "events.plan_id.fk")]),
    "check_plan_count": lambda s, d: Q.check_row_count(fixture.plans(s, d), oracles.EXPECTED_PLANS,
                                                       "plans.row_count"),
    # the dense paths beside the rollups
    "monthly_kpis_dense": lambda s, d: _out(K.monthly_kpis(_ledger(s, d))),
    "trend_dense": lambda s, d: _out(K.trend(_ledger(s, d))),
    "movements_prior_month": lambda s, d: _out(K.at_prior_month(_ledger(s, d), _report_month(s, d))),
    "month_report_empty": lambda s, d: _out(K.month_report(
        fixture.model_events(s, d), fixture.customers(s, d), _report_month(s, d), ["NOWHERE"])),
    "search_accented": lambda s, d: K.search_name(
        fixture.customers(s, d).select("customer_id", F.replace("customer_name", F.lit("Customer"), F.lit("CLI\u00c9NT"))
                                       .alias("customer_name")), oracles.ACCENTED_PATTERN),
    # the stored, published ledger
    "published_movements": lambda s, d: _out(_scan(s, d)),
    "published_counts": _view_counts,
    "movements_clustered": lambda s, d: _out(_clustered_ledger(s, d)),
    "published_at_month": lambda s, d: _out(_published_month(s, d, K.at_month)),
    "published_prior_month": lambda s, d: _out(_published_month(s, d, K.at_prior_month)),
    "stored_event_range": lambda s, d: stored_range(s, _stored(s, d, "events")),
    "stored_month_options": lambda s, d: MonthBounds(s, _stored(s, d, "events")).options(),
    "bound_segment_rows": lambda s, d: _out(_bound_segment(s, d)),
    "bound_segment_search": lambda s, d: _out(_bound_segment(s, d, oracles.NAME_PATTERN)),
    "client_page": lambda s, d: _out(_client_page(s, d)),
    # V4 by bitmaps, and the customers behind it
    "customer_coverage": lambda s, d: customer_coverage(fixture.customers(s, d), fixture.model_events(s, d)),
    "customer_differences": lambda s, d: customer_differences(_broken(s, d)[1], _ledger(s, d)),
    # violating rows with the rules they break, and their counts
    "violating_events": _violating_events,
    "violation_counts": lambda s, d: W.input_violations(*_defective(s, d))[1],
    # checks over defective data: each has violations to find
    "run_checks_broken": lambda s, d: V.run_checks(*_broken(s, d)),
    "validation_report_broken": lambda s, d: V.validation_report(V.run_checks(*_broken(s, d))),
    "reconciliation_violations": lambda s, d: V.reconciliation_violations(V.monthly_waterfall(_broken(s, d)[0])).select(
        "month_date", F.col("difference").cast("double")),
    "continuity_violations": lambda s, d: _out(V.continuity_violations(_broken(s, d)[0]).select("month_date", "starting_mrr")),
    "check_reconciliation_broken": lambda s, d: V.check_reconciliation(_broken(s, d)[0]),
    "check_continuity_broken": lambda s, d: V.check_continuity(_broken(s, d)[0]),
    "check_customer_counts_broken": lambda s, d: V.check_customer_counts(_broken(s, d)[1], _broken(s, d)[0]),
    "check_orphan_customers_broken": lambda s, d: V.check_orphan_customers(*_broken(s, d)[:2]),
    "check_orphan_plans_broken": lambda s, d: V.check_orphan_plans(_broken(s, d)[0], _broken(s, d)[2]),
    "check_integrity_broken": lambda s, d: V.check_integrity(*_broken(s, d)),
    "orphan_customer_rows": lambda s, d: V.orphan_customer_rows(*_broken(s, d)[:2]).select("customer_id", "month_date"),
    "conform_rejects_broken": lambda s, d: conform_counts(_broken_plans(s, d), S.PLANS).select("ok_rows", "rejected_rows"),
    "load_check_broken": lambda s, d: load_counts({"plans": _broken_plans(s, d)}, {"plans": conform(_broken_plans(s, d), S.PLANS)[0]}),
    "check_unique_broken": lambda s, d: _quality(s, d, lambda p, c, e: [
        Q.check_unique(p, "billing_cycle", "plans.billing_cycle.unique"),
        Q.check_unique(c, "country", "customers.country.unique"),
        Q.check_unique(e, "customer_id", "events.customer_id.unique")]),
    "check_rows_broken": lambda s, d: _quality(s, d, lambda p, c, e: [
        Q.check_not_null(e, ["plan_id", "event_id"], "events"),
        Q.check_domain(c, "industry", oracles.INDUSTRIES, "customers.industry.domain"),
        Q.check_min(e, "monthly_amount", 20, "events.monthly_amount.min"),
        Q.check_range(p, "monthly_price", 20, 100, "plans.monthly_price.range"),
        Q.check_row_count(p, 3, "plans.row_count")]),
    "check_foreign_keys_broken": lambda s, d: _quality(s, d, lambda p, c, e: [
        Q.check_fk(e, fixture.supplier_keys(s, d), "customer_id", "customer_id", "events.customer_id.fk"),
        Q.check_fk(e, p.where("monthly_price > 40"), "plan_id", "plan_id", "events.plan_id.fk")]),
    "audit_lifecycle_broken": lambda s, d: Q.reason_counts(Q.lifecycle_violations(_mislabelled(s, d))),
    "audit_price_broken": lambda s, d: Q.reason_counts(Q.price_violations(
        _mislabelled(s, d), fixture.plans(s, d).where("monthly_price < 100").withColumn(
            "monthly_price", F.when(F.col("plan_id").startswith("4"), 30).otherwise(F.col("monthly_price"))))),
    # as-of joins: state at the month's end, and at times of other rows
    "asof_month_state": lambda s, d: _out(_month_end_state(s, d)),
    "asof_shipments": lambda s, d: _out(state_asof(fixture.shipments(s, d), fixture.model_events(s, d), "shipped")),
    "asof_shipments_before": lambda s, d: _out(state_asof(fixture.shipments(s, d), fixture.model_events(s, d), "shipped",
                                                          strict=True, how="inner")),
    "asof_snapshot": lambda s, d: _out(_snapshot(s, d)),
    "asof_snapshot_year_before": lambda s, d: _out(_snapshot(s, d, 12)),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the monthly MRR waterfall (V1) over the full movement ledger."""
    return _out(V.monthly_waterfall(_ledger(spark, SMOKE_DIR)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    sql = oracles.oracle_sql()
    return {name: sql[name] for name in _QUERIES if name in sql} | LLM_ORACLES
