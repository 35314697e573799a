"""Validators and constraints: clean fixture data, then the same data with one thing wrong at a time."""

import pytest
from pyspark.sql import functions as F

from helpers import customers, d, events, ledger, money, plans
from tidemark.operators.movement import movements
from tidemark.plans import checks as V
from tidemark.plans import quality as Q
from tidemark.sources import fixture

SF = "/root/testdata/sf0.001"


def passed(df):
    return {r["check_name"]: r["passed"] for r in df.collect()}


def found(df):
    return [r["violations"] for r in df.collect()]


@pytest.fixture(scope="module")
def built(spark):
    p, c, e = fixture.plans(spark, SF), fixture.customers(spark, SF), fixture.model_events(spark, SF)
    return p, c, fixture.events(spark, SF), movements(e, c, p).cache()


def test_clean_data_passes_everything(built):
    p, c, e, mv = built
    single = [V.check_reconciliation(mv), V.check_continuity(mv), V.check_integrity(mv, c, p)]
    assert all(ok for check in single for ok in passed(check).values())
    rules = {r["rule"]: r["violations"] for r in Q.check_inputs(p, c, e, expected_plans=5).collect()}
    assert len(rules) > 20 and not any(rules.values()), rules


# ----------------------------------------------- one thing wrong in the fixture ledger

def test_one_changed_amount_unbalances_its_month_only(built):
    mv = built[3]
    victim = mv.where("mrr_category = 'Expansion'").orderBy("month_date", "customer_id").first()
    hit = (F.col("customer_id") == victim.customer_id) & (F.col("month_date") == victim.month_date)
    bad = mv.withColumn("mrr_change", F.when(hit, F.col("mrr_change") + money(7)).otherwise(F.col("mrr_change")))
    rows = V.reconciliation_violations(V.monthly_waterfall(bad)).collect()
    assert [(r.month_date, r.difference) for r in rows] == [(victim.month_date, money(7))]
    assert found(V.check_reconciliation(bad)) == [1] and found(V.check_continuity(bad)) == [0]


def test_a_missing_month_breaks_continuity_once(built):
    mv = built[3]
    months = [r.month_date for r in mv.select("month_date").distinct().orderBy("month_date").collect()]
    gap = mv.where(F.col("month_date") != months[len(months) // 2])
    rows = V.continuity_violations(gap).collect()
    assert [r.month_date for r in rows] == [months[len(months) // 2 + 1]]
    assert found(V.check_reconciliation(gap)) == [0]


def test_counts_see_customers_that_one_side_lacks(built):
    _, c, _, mv = built
    active = mv.select("customer_id").distinct()
    some = active.orderBy("customer_id").limit(3)
    assert found(V.check_customer_counts(active, mv)) == [0]
    assert found(V.check_customer_counts(some, mv)) == [active.count() - 3]
    assert found(V.check_customer_counts(active, mv.join(some, "customer_id", "left_anti"))) == [3]


def test_orphans_are_counted_by_row(built):
    p, c, _, mv = built
    gone = mv.groupBy("customer_id").count().orderBy(F.desc("count"), "customer_id").first()
    fewer = c.where(F.col("customer_id") != gone.customer_id)
    assert found(V.check_orphan_customers(mv, fewer)) == [gone["count"]] == [V.orphan_customer_rows(mv, fewer).count()]
    assert passed(V.check_integrity(mv, fewer, p)) == {"referential_integrity": False}
    cheap = p.where("monthly_price < 50")
    rows = mv.join(p.where("monthly_price >= 50"), mv.current_plan_id == p.plan_id, "left_semi").count()
    assert rows > 0
    assert found(V.check_orphan_plans(mv, cheap)) == [rows] == [V.orphan_plan_rows(mv, cheap).count()]
    everything = {r.check_name: r.violations for r in V.run_checks(mv, fewer, cheap).collect()}
    assert everything["referential_integrity"] == gone["count"] + rows and everything["mrr_reconciliation"] == 0


def test_rows_without_a_plan_are_no_orphans(spark):
    model = ledger(spark, [("x", None), ("x", "nowhere"), ("y", "plan_pro")], "customer_id string, current_plan_id string")
    assert found(V.check_orphan_plans(model, plans(spark))) == [1]
    assert found(V.check_orphan_customers(model, customers(spark, ("x",)))) == [1]


# ----------------------------------------------------------------- lifecycles by hand

def test_three_customers_over_half_a_year(spark):
    p, c = plans(spark), customers(spark, ("ann", "bob", "cyd"))
    e = events(spark, [("1", "ann", "plan_pro", "signup", "2024-10-31", 49),
                       ("2", "bob", "plan_enterprise", "signup", "2024-11-01", 199),
                       ("3", "ann", None, "cancel", "2024-12-24", 0),
                       ("4", "bob", "plan_basic", "downgrade", "2025-01-02", 19),
                       ("5", "ann", "plan_basic", "reactivate", "2025-02-28", 19),
                       ("6", "bob", "plan_pro", "upgrade", "2025-03-01", 49)])
    mv = movements(e, c, p)
    got = {}
    for r in mv.orderBy("month_date").collect():
        got.setdefault(r.customer_id, []).append((r.mrr_category, float(r.mrr_change), r.current_plan_name))
    assert got["ann"] == [("New", 49.0, "Professional"), ("No Change", 0.0, "Professional"), ("Churn", -49.0, None),
                          ("No Change", 0.0, None), ("Reactivation", 19.0, "Basic"), ("No Change", 0.0, "Basic")]
    assert got["bob"] == [("New", 199.0, "Enterprise"), ("No Change", 0.0, "Enterprise"), ("Contraction", -180.0, "Basic"),
                          ("No Change", 0.0, "Basic"), ("Expansion", 30.0, "Professional")]
    assert "cyd" not in got, "a customer without events has no rows"
    assert passed(V.run_checks(mv, c.where("customer_id <> 'cyd'"), p))["all_checks"]
    assert not passed(V.run_checks(mv, c, p))["customer_counts"]


def test_repeated_and_missing_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), ("c",), (None,)], "k string")
    assert [(r.violations, r.passed) for r in Q.check_unique(df, "k", "k.unique").collect()] == [(3, False)]
    assert {r.k: r.n for r in Q.duplicate_keys(df, "k").collect()} == {"a": 3, "b": 2}


def test_double_money_does_not_fail_on_binary_noise(spark):
    rows = [("c1", d("2025-01-01"), 0.0, 0.1, 0.1, "New"), ("c2", d("2025-01-01"), 0.0, 0.2, 0.2, "New"),
            ("c1", d("2025-02-01"), 0.1, 0.1, 0.0, "No Change"), ("c2", d("2025-02-01"), 0.2, 0.2, 0.0, "No Change")]
    led = spark.createDataFrame(rows, "customer_id string, month_date date, prev_mrr double, current_mrr double, "
                                      "mrr_change double, mrr_category string")
    assert passed(V.check_reconciliation(led)) == {"mrr_reconciliation": True}
    assert passed(V.check_continuity(led)) == {"mrr_continuity": True}


def test_run_checks_is_lazy_and_agrees_with_the_single_checks(spark, built):
    p, c, _, mv = built
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    df = V.run_checks(mv, c, p)
    assert len(tracker.getJobIdsForGroup(None)) == before
    got = {r.check_name: r.violations for r in df.collect()}
    single = [V.check_reconciliation(mv), V.check_continuity(mv), V.check_customer_counts(c, mv), V.check_integrity(mv, c, p)]
    assert got == {r.check_name: r.violations for x in single for r in x.collect()} | {"all_checks": 0}


def test_null_ids_and_null_money(spark):
    schema = ("customer_id string, month_date date, prev_mrr decimal(10,2), current_mrr decimal(10,2), "
              "mrr_change decimal(10,2), mrr_category string, current_plan_id string")
    rows = [("a", d("2025-01-01"), money(0), None, money(19), "New", None),
            (None, d("2025-02-01"), money(5), money(5), money(0), "No Change", None)]
    led = spark.createDataFrame(rows, schema)
    dim = spark.createDataFrame([("a",)], "customer_id string")
    plan = spark.createDataFrame([("p",)], "plan_id string")
    got = {r.check_name: r.violations for r in V.run_checks(led, dim, plan).collect()}
    # a NULL balance is a difference; a NULL id is no customer to count, but an orphan row
    assert got == {"mrr_reconciliation": 1, "mrr_continuity": 1, "customer_counts": 0, "referential_integrity": 1, "all_checks": 3}
    assert V.check_continuity(led).first()["violations"] == 1
    assert V.check_reconciliation(led).first()["violations"] == 1
    assert V.check_customer_counts(dim, led).first()["passed"]
