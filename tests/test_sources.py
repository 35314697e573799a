"""Readers, conformance, publication with rollback, row counts."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import customers, d, events, money, plans
from tidemark import schemas as S
from tidemark.plans import quality as Q
from tidemark.sources import publish as P
from tidemark.sources import tables as T


def test_readers_cast_strings_and_floats(spark, tmp_dir):
    raw = spark.createDataFrame(
        [("evt_1", "cust_1", "plan_basic", "signup", "2025-01-15", 19.0),
         ("evt_2", "cust_1", None, "cancel", "2025-02-10", 0.0)],
        "event_id string, customer_id string, plan_id string, event_type string, event_date string, "
        "monthly_amount double")
    raw.write.parquet(f"{tmp_dir}/events")
    ev = T.read_events(spark, f"{tmp_dir}/events")
    assert [(f.name, f.dataType) for f in ev.schema.fields] == [(f.name, f.dataType) for f in S.EVENTS.fields]
    rows = ev.orderBy("event_id").collect()
    assert rows[0].event_date == d("2025-01-15") and rows[0].monthly_amount == money(19)


def test_conform_reports_rejects(spark):
    raw = spark.createDataFrame(
        [("c1", "A", "2025-01-01", "US", "Tech", "SMB"), ("c2", "B", "not a date", "US", "Tech", "SMB"),
         ("c3", "C", None, "US", "Tech", "SMB")],
        "customer_id string, customer_name string, signup_date string, country string, industry string, "
        "company_size string")
    ok, rejects = T.conform(raw, S.CUSTOMERS)
    assert sorted(r.customer_id for r in ok.collect()) == ["c1", "c3"]  # NULL is not a cast failure
    bad = rejects.collect()
    assert [(r.customer_id, r.reject_columns) for r in bad] == [("c2", ["signup_date"])]
    assert T.reject_counts(rejects).collect()[0].asDict() == {"column_name": "signup_date", "rejects": 1}


def test_publish_lists_version_only_after_checks(spark, tmp_dir):
    p, c = plans(spark), customers(spark)
    e = events(spark, [("evt_1", "cust_1", "plan_basic", "signup", "2025-01-15", 19)])
    base = f"{tmp_dir}/warehouse"
    assert P.current_version(spark, base) is None
    v1 = P.publish(spark, {"plans": p, "customers": c, "events": e}, base,
                   checks=lambda t: Q.check_inputs(t["plans"], t["customers"], t["events"], expected_plans=3))
    assert P.current_version(spark, base) == v1
    assert P.read_published(spark, base, "events").count() == 1
    # A load whose checks fail is staged but never listed: readers keep v1.
    bad_e = events(spark, [("evt_1", "cust_9", "plan_basic", "signup", "2025-01-15", 19)])
    with pytest.raises(P.PublishError):
        P.publish(spark, {"plans": p, "customers": c, "events": bad_e}, base,
                  checks=lambda t: Q.check_inputs(t["plans"], t["customers"], t["events"]))
    assert P.current_version(spark, base) == v1
    assert P.read_published(spark, base, "events").collect()[0].customer_id == "cust_1"


def test_load_counts_and_row_counts(spark):
    p = plans(spark)
    out = P.load_counts({"plans": p}, {"plans": p.limit(2)}).collect()[0]
    assert (out.input_rows, out.stored_rows, out.passed) == (3, 2, False)
    assert {r.table_name: r.row_count for r in T.row_counts({"plans": p, "c": customers(spark)}).collect()} == \
        {"plans": 3, "c": 1}


def test_register_views(spark):
    P.register_views({"dim_plans": plans(spark)})
    assert spark.sql("SELECT count(*) AS n FROM dim_plans").collect()[0].n == 3


def test_checkpoint_dir_comes_from_session(spark):
    from tidemark.session import checkpoint_dir
    assert checkpoint_dir(spark)


def test_ledger_written_by_month_prunes_partitions(spark, tmp_dir):
    from tidemark.operators.movement import movements
    e = events(spark, [("evt_1", "cust_1", "plan_basic", "signup", "2025-01-15", 19),
                       ("evt_2", "cust_1", "plan_pro", "upgrade", "2025-03-02", 49)])
    P.write_ledger(movements(e, customers(spark), plans(spark)), f"{tmp_dir}/ledger")
    stored = spark.read.parquet(f"{tmp_dir}/ledger")
    march = stored.where(F.col("month_date") == d("2025-03-01"))
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_date" in plan
    assert [(r.mrr_category, r.current_mrr) for r in march.collect()] == [("Expansion", money(49))]
    folders = sorted(n for n in os.listdir(f"{tmp_dir}/ledger") if n.startswith("month_date="))
    assert folders == ["month_date=2025-01-01", "month_date=2025-02-01", "month_date=2025-03-01"]


def test_reader_reports_rejects(spark, tmp_dir):
    raw = spark.createDataFrame([("p1", "Basic", "19.00", "monthly"), ("p2", "Pro", "lots", "monthly")],
                                "plan_id string, plan_name string, monthly_price string, billing_cycle string")
    raw.write.parquet(f"{tmp_dir}/plans")
    ok, rejects = T.read_plans(spark, f"{tmp_dir}/plans", with_rejects=True)
    assert [r.plan_id for r in ok.collect()] == ["p1"]
    assert [(r.plan_id, r.reject_columns) for r in rejects.collect()] == [("p2", ["monthly_price"])]
    assert T.read_plans(spark, f"{tmp_dir}/plans").count() == 1


def test_conform_counts_in_one_pass(spark):
    raw = spark.createDataFrame([("p1", "Basic", "19.00", "monthly"), ("p2", "Pro", "lots", "monthly"),
                                 ("p3", "Max", None, "monthly")],
                                "plan_id string, plan_name string, monthly_price string, billing_cycle string")
    r = T.conform_counts(raw, S.PLANS).collect()[0]
    assert (r.ok_rows, r.rejected_rows) == (2, 1)


def test_to_client_refuses_large_results(spark):
    assert len(T.to_client(plans(spark), max_rows=3)) == 3
    with pytest.raises(T.ResultTooLarge):
        T.to_client(plans(spark), max_rows=2)


def test_the_version_listed_last_is_current(spark, tmp_dir):
    """Two overlapping loads: the one that started first is listed last, and is current."""
    base = f"{tmp_dir}/overlap"
    df = spark.createDataFrame([(1,)], "x int")
    listed = {}

    def slow(stored):  # while the first load is checked, a second one starts and ends
        listed["second"] = P.publish(spark, {"t": df}, base)
        return spark.createDataFrame([(True,)], "passed boolean")
    first = P.publish(spark, {"t": df.union(df)}, base, checks=slow)
    assert first < listed["second"], "names follow the start"
    assert P.current_version(spark, base) == first
    assert P.read_published(spark, base, "t").count() == 2


def test_unreadable_manifest_is_an_error(spark, tmp_dir):
    import os

    import pytest
    os.makedirs(f"{tmp_dir}/broken/{P.MANIFEST}")
    with open(f"{tmp_dir}/broken/{P.MANIFEST}/{1:020d}.json", "w") as f:
        f.write("not an entry")
    assert P.current_version(spark, f"{tmp_dir}/nothing") is None
    with pytest.raises(Exception):  # noqa: B017
        P.current_version(spark, f"{tmp_dir}/broken")


def test_a_large_month_is_split_over_files(spark, tmp_dir):
    df = (spark.range(60000).select((F.col("id") % 3).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
          .withColumn("month_date", F.when(F.col("k") < 2, F.lit("2025-01-01")).otherwise(F.lit("2025-02-01")).cast("date")))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        P.write_ledger(df, f"{tmp_dir}/split", partitions=4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    import glob
    assert len(glob.glob(f"{tmp_dir}/split/month_date=2025-01-01/*.parquet")) > 2
    assert spark.read.parquet(f"{tmp_dir}/split").count() == 60000
