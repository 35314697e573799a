"""Customers that one side lacks, by bitmaps, against sets."""

import random

from tidemark.plans import checks as V
from tidemark.plans.coverage import customer_coverage, customer_differences, distinct_customers


def ids(spark, numbers):
    return spark.createDataFrame([(None if n is None else f"cust_{n:06d}", i) for i, n in enumerate(numbers)], "customer_id string, x int")


def test_equals_sets(spark):
    rng = random.Random(2)
    for _ in range(4):
        a = [rng.randrange(200_000) for _ in range(3000)] + [0, 1, 32767, 32768, 32769, None]
        b = [n for n in a if rng.random() < 0.99] * 2 + [250_000, None]
        left, right = ids(spark, a), ids(spark, b)
        sa, sb = set(a) - {None}, set(b) - {None}
        assert distinct_customers(right).first().n == len(sb)
        assert tuple(customer_coverage(left, right).first()) == (len(sa), len(sb), len(sa) == len(sb))
        got = {(r.customer_id, r.missing_in) for r in customer_differences(left, right).collect()}
        assert got == {(f"cust_{n:06d}", "model") for n in sa - sb} | {(f"cust_{n:06d}", "dimension") for n in sb - sa}
        check = V.check_customer_counts(left, right).first()
        assert check.violations == abs(len(sa) - len(sb))


def test_equal_counts_can_hide_differences(spark):
    left, right = ids(spark, [1, 2, 3]), ids(spark, [1, 2, 4, 4])
    assert customer_coverage(left, right).first().passed
    assert {tuple(r) for r in customer_differences(left, right).collect()} == {("cust_000003", "model"), ("cust_000004", "dimension")}


def test_empty(spark):
    none, some = ids(spark, []), ids(spark, [5])
    assert tuple(customer_coverage(none, none).first()) == (0, 0, True) and customer_differences(none, none).count() == 0
    assert [tuple(r) for r in customer_differences(none, some).collect()] == [("cust_000005", "dimension")]


def test_a_hot_customer_is_a_bit(spark):
    """The bitmaps are built before the shuffle: a customer's rows reach it as one bit per task."""
    df = ids(spark, [7] * 5000 + list(range(100)))
    plan = distinct_customers(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") > plan.index("Exchange hashpartitioning(") > plan.index("bitmap_construct_agg")
