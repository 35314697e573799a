"""refresh / validate end to end on the smallest driver tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.sources import fixture
from tidemark.sources import publish as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="tidemark-jobs-")
    p, c, e = fixture.inputs(spark, SF)
    # inputs as another system would hand them over: dates as strings, money as floats
    e = e.select(*[F.col(x).cast("string") if x == "event_date" else
                   F.col(x).cast("double") if x == "monthly_amount" else F.col(x) for x in e.columns])
    for name, df in (("plans", p), ("customers", c), ("events", e)):
        df.write.parquet(f"{root}/in/{name}")
    return root


def test_refresh_then_validate(spark, inputs):
    base = f"{inputs}/warehouse"
    v = jobs.refresh(spark, f"{inputs}/in/plans", f"{inputs}/in/customers", f"{inputs}/in/events", base,
                     expected_plans=5, validate=True)
    assert P.current_version(spark, base) == v
    out = {r.check_name: r.passed for r in jobs.validate(spark, base).collect()}
    assert out["all_checks"] is True
    assert spark.sql("SELECT count(*) AS n FROM mrr_movements").first().n == \
        spark.sql("SELECT count(DISTINCT customer_id, month_date) AS n FROM mrr_movements").first().n


def test_refresh_refuses_failed_constraints(spark, inputs):
    base = f"{inputs}/warehouse_bad"
    with pytest.raises(P.PublishError):
        jobs.refresh(spark, f"{inputs}/in/plans", f"{inputs}/in/customers", f"{inputs}/in/events", base,
                     expected_plans=3)
    assert P.current_version(spark, base) is None


def test_refresh_refuses_rows_that_do_not_cast(spark, inputs):
    bad = spark.read.parquet(f"{inputs}/in/events").withColumn(
        "event_date", F.when(F.col("event_id") == F.lit("evt_000000000001"), F.lit("31/02/1999"))
        .otherwise(F.col("event_date")))
    bad.write.parquet(f"{inputs}/in/events_bad")
    with pytest.raises(jobs.RejectedRows):
        jobs.refresh(spark, f"{inputs}/in/plans", f"{inputs}/in/customers", f"{inputs}/in/events_bad",
                     f"{inputs}/warehouse_rej")


def test_cli_validate(spark, inputs):
    from tidemark.__main__ import main
    base = f"{inputs}/warehouse"
    if P.current_version(spark, base) is None:
        jobs.refresh(spark, f"{inputs}/in/plans", f"{inputs}/in/customers", f"{inputs}/in/events", base)
    assert main(["validate", base]) == 0


def test_version_is_listed_only_with_its_ledger(spark, inputs):
    base = f"{inputs}/warehouse_derived_fails"
    p = spark.read.parquet(f"{inputs}/in/plans")

    def broken(stored):
        def write(path):
            raise RuntimeError("ledger build failed")
        return {"ledger": write}

    with pytest.raises(RuntimeError):
        P.publish(spark, {"plans": p}, base, derived=broken)
    assert P.current_version(spark, base) is None


def test_refresh_with_failing_validation_lists_nothing(spark, inputs):
    import datetime as dt

    from tidemark import schemas as S
    extra = spark.createDataFrame([("cust_without_events", "Idle", dt.date(2000, 1, 1), "X", "Y", "SMB")],
                                  S.CUSTOMERS)
    spark.read.parquet(f"{inputs}/in/customers").unionByName(extra).write.parquet(f"{inputs}/in/customers_plus")
    base = f"{inputs}/warehouse_invalid"
    with pytest.raises(P.PublishError):
        jobs.refresh(spark, f"{inputs}/in/plans", f"{inputs}/in/customers_plus", f"{inputs}/in/events", base,
                     validate=True)
    assert P.current_version(spark, base) is None
    # without validation the same load is published (the reference loads, then validates separately)
    v = jobs.refresh(spark, f"{inputs}/in/plans", f"{inputs}/in/customers_plus", f"{inputs}/in/events", base)
    out = {r.check_name: r.passed for r in jobs.validate(spark, base, v).collect()}
    assert out["customer_counts"] is False and out["all_checks"] is False
