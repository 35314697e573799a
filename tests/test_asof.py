"""The as-of join against brute force, its skew and its plan."""

import datetime as dt
import random
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, state_asof
from tidemark.operators.sequence import ordered_lag
from tidemark.plans.lifecycle import derive_event_type

sys.path.insert(0, "tools")

LEFT = "k string, at timestamp_ntz, name string, _t int, _side int, row string"
RIGHT = "k string, time timestamp_ntz, id string, v int"
START = dt.datetime(2024, 1, 1)


def brute(left, right, strict=False):
    out = []
    for row in left:
        k, at = row[:2]
        found = [r for r in right if None not in (k, at, r[0], r[1]) and r[0] == k and (r[1] < at if strict else r[1] <= at)]
        best = max(found, key=lambda r: (r[1], r[2]), default=None)
        out.append((*row, *(best[2:] if best else (None, None))))
    return sorted(out, key=str)


def joined(spark, left, right, **options):
    df = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", ("at", "time"), tie=["id"],
                   values=["id", "v"], **options)
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10**6), st.booleans(), st.sampled_from(["date", "hour", "month", "one"]))
def test_equals_brute_force(spark, seed, strict, by):
    rng = random.Random(seed)

    def when():
        return None if rng.random() < 0.03 else START + dt.timedelta(hours=rng.randrange(24 * 70) if rng.random() < 0.7 else 24 * 30)

    def key():
        return rng.choices(["hot", "a", "b", None], [6, 2, 2, 0.4])[0]

    left = [(key(), when(), f"n{i}", i, 2, "x") for i in range(rng.randrange(80))]
    right = [(key(), when(), f"id{i:03d}", rng.choice([i, None])) for i in range(rng.randrange(80))]
    bucket = {"date": None, "hour": lambda t: F.date_trunc("hour", t), "month": lambda t: F.trunc(t, "month"), "one": lambda t: F.lit(1)}[by]
    assert joined(spark, left, right, strict=strict, bucket=bucket) == brute(left, right, strict)


def test_inner_clashes_and_empty_sides(spark):
    left = [("a", START, "n", 1, 2, "x"), ("b", START, "n", 1, 2, "x"), (None, START, "n", 1, 2, "x")]
    right = [("a", START, "id1", 7)]
    assert [r[-1] for r in joined(spark, left, right, how="inner")] == [7]
    assert joined(spark, left, []) == brute(left, []) and joined(spark, [], right) == []
    with pytest.raises(ValueError, match="both sides"):
        asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame([("a", START, "n", 1)], "k string, time timestamp_ntz, name string, v int"),
                  "k", ("at", "time"))
    with pytest.raises(ValueError, match="how"):
        joined(spark, left, right, how="outer")


def test_two_keys(spark):
    left = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 1, 5)], "k string, n int, t int")
    right = spark.createDataFrame([("a", 1, 4, "x"), ("a", 1, 5, "y"), ("a", 2, 6, "z"), ("b", 1, 1, "w")], "k string, n int, s int, v string")
    got = asof_join(left, right, ["k", "n"], ("t", "s"), bucket=lambda t: F.floor(t / 2))
    assert sorted((r.k, r.n, r.s, r.v) for r in got.collect()) == [("a", 1, 5, "y"), ("a", 2, None, None), ("b", 1, 1, "w")]


def test_state_asof(spark):
    events = spark.createDataFrame([("c", dt.date(2024, 1, 5), "e2", 49, "pro"), ("c", dt.date(2024, 1, 5), "e1", 19, "basic"),
                                    ("c", dt.date(2024, 2, 5), "e3", 0, None)],
                                   "customer_id string, event_date date, event_id string, monthly_amount int, plan_id string")
    times = spark.createDataFrame([("c", dt.date(2024, 1, 4)), ("c", dt.date(2024, 1, 5)), ("c", dt.date(2024, 2, 5)), ("d", dt.date(2024, 2, 5))],
                                  "customer_id string, day date")
    got = {(r.customer_id, str(r.day)): (r.monthly_amount, r.plan_id) for r in state_asof(times, events, "day").collect()}
    assert got == {("c", "2024-01-04"): (None, None), ("c", "2024-01-05"): (49, "pro"), ("c", "2024-02-05"): (0, None), ("d", "2024-02-05"): (None, None)}


def plan_of(df, tools):
    spark = df.sparkSession
    return tools.summarize(df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def static(spark):
    """Plans as for tables of unknown size: no broadcast by estimate, no adaptive shell around the plan."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_no_join_and_three_exchanges(static, tmp_dir):
    import plan_report

    spark = static
    spark.createDataFrame([("a", START, "n", 1, 2, "x")], LEFT).write.parquet(f"{tmp_dir}/l.parquet")
    spark.createDataFrame([("a", START, "i", 1)], RIGHT).write.parquet(f"{tmp_dir}/r.parquet")
    df = asof_join(spark.read.parquet(f"{tmp_dir}/l.parquet"), spark.read.parquet(f"{tmp_dir}/r.parquet"), "k", ("at", "time"), tie=["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    s = plan_report.summarize(plan)
    assert s["ops"]["hash exchange"] == 3 and len(s["scans"]) == 4, plan
    assert "Join" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan


def test_lag_takes_three_exchanges_and_two_scans(static, tmp_dir):
    import plan_report

    spark = static
    rows = [("e1", "c", "p", dt.date(2024, 1, 1), 1, "wide")]
    spark.createDataFrame(rows, "event_id string, customer_id string, plan_id string, event_date date, monthly_amount int, note string").write.parquet(
        f"{tmp_dir}/e.parquet")
    plan = derive_event_type(spark.read.parquet(f"{tmp_dir}/e.parquet"))._jdf.queryExecution().executedPlan().toString()
    s = plan_report.summarize(plan)
    assert s["ops"]["hash exchange"] == 3 and "Join" not in plan and "SinglePartition" not in plan, plan
    assert sorted(n for _, _, n in s["scans"]) == [4, 6], "the carry reads only key, order and the lagged column"


def test_hot_day_is_cut(spark):
    """A third of all rows on one customer's day: cut by the identifiers' first characters, exact."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", dt.date(2024, 1, 1 + (0 if i % 3 == 0 else i % 28)), f"evt_{(i * 7919) % 100003:06d}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, day date, id string, v int")
    cut = F.substring("id", 1, 7)
    got = {r.id: r.p_v for r in ordered_lag(df, "k", ["day", "id"], ["v"], prefix="p_", cut=cut).collect()}
    largest = df.groupBy("k", "day", cut.alias("c")).count().agg(F.max("count")).first()[0]
    assert largest < 100 < df.where("k = 'hot'").count()
    before = {}
    for k, _, i, v in sorted(rows):
        assert got[i] == before.get(k), i
        before[k] = v


def test_null_keys_and_values_lag(spark):
    rows = [(None, 1, "a", 5), (None, 2, "b", None), (None, 3, "c", 7), ("k", 1, "d", 1)]
    df = spark.createDataFrame(rows, "k string, day int, id string, v int")
    got = {r.id: r.prev_v for r in ordered_lag(df, "k", ["day", "id"], ["v"]).collect()}
    assert got == {"a": None, "b": 5, "c": None, "d": None}
