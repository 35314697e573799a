"""A third of all events on one customer: results stay exact and the hot
customer stays small after the month-close step."""

import duckdb
import pytest
from pyspark.sql import functions as F

import oracles
from tidemark.operators import movement as M
from tidemark.operators.sequence import ordered_lag
from tidemark.sources import fixture

SF = "/root/testdata/sf0.01"
HOT = "cust_000000000"


@pytest.fixture(scope="module")
def skewed(spark):
    raw = fixture.raw_events(spark, SF)
    # every third order moves to one customer (a test input, not a registered query)
    key = F.substring("event_id", 5, 12).cast("bigint")
    ev = raw.withColumn("customer_id", F.when(key % 3 == 0, F.lit(HOT)).otherwise(F.col("customer_id")))
    return ev, fixture.customers(spark, SF), fixture.plans(spark, SF)


def test_hot_customer_holds_a_third(skewed):
    ev = skewed[0]
    share = ev.where(F.col("customer_id") == HOT).count() / ev.count()
    assert share > 0.33


def test_ledger_under_skew_matches_sql_model(spark, skewed):
    ev, cust, plans = skewed
    got = M.movements(ev, cust, plans).select("customer_id", "month_date", "current_mrr", "prev_mrr",
                                              "mrr_category", "current_plan_id", "prev_plan_id")
    con = duckdb.connect()
    con.register("sub_events", ev.toPandas())
    con.register("sub_customers", cust.toPandas())
    con.register("sub_plans", plans.toPandas())
    sql = ("WITH " + oracles.MODEL.strip().rstrip(",") + "\n SELECT customer_id, month_date, current_mrr, "
           "prev_mrr, mrr_category, current_plan_id, prev_plan_id FROM mv")
    expect = sorted(tuple(r) for r in con.execute(sql).fetchall())
    assert sorted(tuple(r) for r in got.collect()) == expect


def test_hot_customer_is_bounded_after_month_close(skewed):
    ev = skewed[0]
    months = M.month_spine(ev).count()
    seg = M.segments(ev)
    assert seg.where(F.col("customer_id") == HOT).count() <= months
    # the largest window partition is no bigger than a few customers' month-close rows
    per_part = seg.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert per_part < seg.count()


def test_ordered_lag_under_skew(skewed):
    ev = skewed[0].select("event_id", "customer_id", "event_date", "monthly_amount")
    got = {r.event_id: r.prev_event_id for r in
           ordered_lag(ev, "customer_id", ["event_date", "event_id"], ["event_id"]).collect()}
    pdf = ev.toPandas().sort_values(["customer_id", "event_date", "event_id"])
    pdf["pe"] = pdf.groupby("customer_id")["event_id"].shift(1)
    assert all(got[r.event_id] == (r.pe if isinstance(r.pe, str) else None) for r in pdf.itertuples())
