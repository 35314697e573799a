"""Violating rows: every rule, counts from the rows, and the number of scans."""

import datetime as dt

from helpers import customers, events, plans

from tidemark.plans import quality as Q
from tidemark.plans import violations as W


def found(df, rules, key):
    return sorted((tuple(r) for r in W.violating_rows(df, rules).select(key, W.BROKEN).collect()), key=str)


def test_each_rule_on_its_own_row(spark):
    p, c = plans(spark), customers(spark, ("c1", "c2"))
    raw = [("ok", "c1", "plan_basic", "signup", "2025-01-01", 19), ("ok_null_plan", "c1", None, "cancel", "2025-02-01", 0),
           ("e_type", "c1", "plan_basic", "renewal", "2025-01-01", 19), ("e_min", "c1", "plan_basic", "signup", "2025-01-01", -1),
           ("e_customer", "c9", "plan_basic", "signup", "2025-01-01", 19), ("e_plan", "c2", "plan_gone", "signup", "2025-01-01", 19),
           ("twice", "c2", "plan_pro", "signup", "2025-01-01", 49), ("twice", "c9", "plan_pro", "renewal", "2025-01-01", 49)]
    rules = W.input_rules(p, c)["events"]
    assert found(events(spark, raw), rules, "event_id") == sorted([
        ("e_type", ["events.event_type.domain"]), ("e_min", ["events.monthly_amount.min"]), ("e_customer", ["events.customer_id.fk"]),
        ("e_plan", ["events.plan_id.fk"]), ("twice", ["events.event_id.unique"]),
        ("twice", ["events.event_type.domain", "events.event_id.unique", "events.customer_id.fk"])], key=str)


def test_nulls_break_only_not_null(spark):
    df = spark.createDataFrame([(None, None, None, None, None, None, "x"), (None, None, None, None, None, None, "y")],
                               "event_id string, customer_id string, plan_id string, event_type string, event_date date, monthly_amount decimal(10,2), n string")
    rules = W.input_rules(plans(spark), customers(spark))["events"]
    assert [r[1] for r in found(df, rules, "n")] == [[f"events.{c}.not_null" for c in ("event_id", "customer_id", "event_type", "event_date", "monthly_amount")]] * 2


def test_counts_agree_with_the_checks(spark):
    p = plans(spark, [("a", "A", None, "monthly"), ("a", "B", None, "yearly"), ("b", "C", None, "monthly")][:0] or None)
    c = customers(spark, ("c1", "c1", "c2"), size="Tiny")
    e = events(spark, [("e1", "c1", "plan_basic", "signup", "2025-01-01", 19), ("e1", "c3", "gone", "trial", "2025-01-01", -2),
                       ("e2", "c3", "gone", "signup", "2025-01-02", 19)])
    tables, counts = W.input_violations(p, c, e)
    got = {r.rule: r.violating_rows for r in counts.collect()}
    checks = {r.rule: r.violations for r in Q.check_inputs(p, c, e).collect()}
    assert set(checks) == set(got)
    for rule, n in checks.items():
        if rule.endswith(".unique"):
            assert (got[rule] > 0) == (n > 0)  # a check counts keys, the rows are all that share one
        else:
            assert got[rule] == n, rule
    assert got["customers.customer_id.unique"] == 2 and got["customers.company_size.domain"] == 3 and got["events.customer_id.fk"] == 2
    assert {name: df.count() for name, df in tables.items()} == {"plans": 0, "customers": 3, "events": 3}
    assert all(r.passed == (r.violating_rows == 0) for r in counts.collect())


def test_hot_broken_key(spark):
    """A third of all rows name one customer that is not there, and one plan that is not there."""
    raw = [(f"e{i}", "lost" if i % 3 == 0 else "c1", "gone" if i % 3 == 0 else None, "signup", dt.date(2025, 1, 1).isoformat(), 1) for i in range(3000)]
    rules = W.input_rules(plans(spark), customers(spark, ("c1",)))["events"]
    rows = W.violating_rows(events(spark, raw), rules)
    assert rows.count() == 1000 and rows.select(W.BROKEN).distinct().collect()[0][0] == ["events.customer_id.fk", "events.plan_id.fk"]


def test_row_rules_read_the_table_once(spark, tmp_dir):
    customers(spark, ("c1", "c2")).write.parquet(f"{tmp_dir}/c")
    df = spark.read.parquet(f"{tmp_dir}/c")
    rules = W.Rules("customers", None, ["customer_id", "country"], {"company_size": ["SMB"]})
    plan = W.violating_rows(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
    keyed = W.violating_rows(df, W.Rules("customers", "customer_id", ["country"]))._jdf.queryExecution().optimizedPlan().toString()
    assert keyed.count("Relation ") == 2, "the second reads the key alone"


def test_empty_tables(spark):
    e = events(spark, [("e1", "c1", "plan_basic", "signup", "2025-01-01", 19)])
    tables, counts = W.input_violations(plans(spark).limit(0), customers(spark).limit(0), e.limit(0))
    assert counts.where("not passed").count() == 0 and all(df.count() == 0 for df in tables.values())
    rules = W.input_rules(plans(spark).limit(0), customers(spark).limit(0))["events"]
    assert found(e, rules, "event_id") == [("e1", ["events.customer_id.fk", "events.plan_id.fk"])]
