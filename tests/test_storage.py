"""Stored tables: buckets by customer, the list of versions, bounds from footers, months pruned at run time."""

import glob
import os
import re
import threading
import time

import helpers as H
import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import movement as M
from tidemark.operators.rollup import monthly_rollup
from tidemark.operators.snapshot import asof_snapshot
from tidemark.plans import jobs
from tidemark.plans import metrics as K
from tidemark.sources import fixture, versions
from tidemark.sources import publish as P
from tidemark.sources.clustered import Clustering, read_clustered, write_clustered
from tidemark.sources.stats import MonthBounds, stored_range

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Events, customers and month-close rows as a version stores them."""
    base = str(tmp_path_factory.mktemp("stored"))
    by = Clustering("customer_id", 5)
    fixture.events(spark, SF).write.parquet(f"{base}/events")
    fixture.plans(spark, SF).write.parquet(f"{base}/plans")
    write_clustered(fixture.customers(spark, SF), f"{base}/customers", by)
    write_clustered(M.month_close(spark.read.parquet(f"{base}/events")), f"{base}/closes", by)
    return base, by


@pytest.fixture
def static(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clustered(spark, stored):
    base, by = stored
    return read_clustered(spark, f"{base}/closes", by), read_clustered(spark, f"{base}/customers", by)


def test_no_shuffle_below_the_window(static, stored):
    closes, customers = clustered(static, stored)
    text = plan(M.close_segments(closes, F.lit("2001-08-01").cast("date"), customers))
    assert "Window" in text and "SortMergeJoin" in text and "Exchange" not in text, text
    ledger = plan(M.movements_of_closes(closes, customers, static.read.parquet(f"{stored[0]}/plans"), F.lit("2001-08-01").cast("date")))
    assert "hashpartitioning(customer_id" not in ledger and "SinglePartition" not in ledger
    above = set(re.findall(r"Exchange hashpartitioning\((\w+)#", ledger))
    assert above == {"current_plan_id", "prior_plan_id"}, "the names of the two plans of a row"
    assert text.count("Bucketed: true") == 2


def test_clustered_ledger_has_the_same_rows(spark, stored):
    base, by = stored
    closes, customers = clustered(spark, stored)
    events, plans = spark.read.parquet(f"{base}/events"), spark.read.parquet(f"{base}/plans")
    want = rows(M.movements(events, customers, plans))
    assert rows(M.movements_of_closes(closes, customers, plans)) == want
    assert rows(M.movements_of_closes(closes, customers, plans, MonthBounds(spark, f"{base}/events").end())) == want


def test_one_file_a_bucket_and_another_session(spark, stored):
    base, by = stored
    files = [os.path.basename(f) for f in glob.glob(f"{base}/closes/*.parquet")]
    assert len(files) == by.buckets and len({re.search(r"_(\d{5})\.", f).group(1) for f in files}) == by.buckets
    other = spark.newSession()
    spark.sql(f"DROP TABLE {read_clustered(spark, f'{base}/closes', by).inputFiles() and _name(base)}")  # the files stay
    again = read_clustered(other, f"{base}/closes", by)
    assert again.count() == spark.read.parquet(f"{base}/closes").count()
    assert "Bucketed: true" in again.groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()


def _name(base):
    from tidemark.sources import clustered as module

    return module._table(f"{base}/closes")


def test_refresh_stores_clustered_tables(spark, tmp_dir):
    p, c, e = fixture.inputs(spark, SF)
    for name, df in (("plans", p), ("customers", c.where("signup_date is not null")), ("events", e)):
        df.write.parquet(f"{tmp_dir}/in/{name}")
    base = f"{tmp_dir}/w"
    v = jobs.refresh(spark, *[f"{tmp_dir}/in/{n}" for n in ("plans", "customers", "events")], base, validate=True, partitions=3)
    entry = versions.current(spark, base)
    assert (entry["version"], entry["number"]) == (v, 1) and sorted(entry["clustered"]) == ["closes", "customers"]
    closes = P.read_published(spark, base, "closes")
    assert "Bucketed: true" in closes.groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
    assert rows(P.read_published(spark, base, "ledger").select(*S.MOVEMENT_COLUMNS)) == rows(M.movements(e, c, p))


# ------------------------------------------------------------- list of versions

def load(spark, base, n):
    return P.publish(spark, {"t": spark.range(n)}, base)


def test_two_interleaved_publishers_are_both_listed(spark, tmp_dir, monkeypatch):
    """The second sees the same highest number as the first: its entry fails, and it takes the next number."""
    base = f"{tmp_dir}/two"
    first = load(spark, base, 1)
    monkeypatch.setattr(versions, "highest", lambda *_: 0)
    second = load(spark, base, 2)
    listed = {r.number: r.version for r in versions.versions(spark, base).collect()}
    assert listed == {1: first, 2: second} and P.current_version(spark, base) == second


def test_many_writers_at_once(spark, tmp_dir):
    base = f"{tmp_dir}/many"
    names = [versions.new_version() for _ in range(12)]
    for n in names:
        os.makedirs(f"{base}/{n}")
    numbers = {}
    threads = [threading.Thread(target=lambda n=n: numbers.__setitem__(n, versions.list_version(spark, base, n))) for n in names]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(numbers.values()) == list(range(1, 13))
    assert {r.version: r.number for r in versions.versions(spark, base).collect()} == numbers
    assert versions.current(spark, base)["number"] == 12


def test_order_is_the_entries_and_not_the_clocks(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/clock"
    first = load(spark, base, 1)
    monkeypatch.setattr(versions.time, "time", lambda: 1.0)  # a writer whose clock is decades behind
    second = load(spark, base, 2)
    assert second < first and P.current_version(spark, base) == second


def test_create_if_absent(spark, tmp_dir):
    path = f"{tmp_dir}/x/entry.json"
    assert versions.create_if_absent(spark, path, "one") and not versions.create_if_absent(spark, path, "two")
    assert open(path).read() == "one" and os.listdir(f"{tmp_dir}/x") == ["entry.json"]


def test_unlisted_versions_are_removed(spark, tmp_dir):
    base = f"{tmp_dir}/orphans"
    kept = load(spark, base, 1)
    with pytest.raises(P.PublishError):
        P.publish(spark, {"t": spark.range(3)}, base, checks=lambda t: spark.range(1).select(F.lit(False).alias("passed")))
    os.makedirs(f"{base}/notes")
    assert versions.remove_unlisted(spark, base) == [], "a load of the last days may still be running"
    time.sleep(1.1)
    gone = versions.remove_unlisted(spark, base, older_than=1)
    assert len(gone) == 1 and sorted(os.listdir(base)) == sorted([kept, "_manifest", "notes"])
    assert P.read_published(spark, base, "t").count() == 1
    with pytest.raises(FileNotFoundError):
        versions.list_version(spark, base, gone[0])
    assert versions.unlisted(spark, f"{tmp_dir}/nothing", 0) == []


def test_unlisted_versions_cannot_be_read(spark, tmp_dir):
    base = f"{tmp_dir}/unlisted"
    load(spark, base, 1)
    with pytest.raises(P.PublishError):
        P.read_published(spark, base, "t", "v000000000000000-00000000")


def test_an_entry_being_written_lists_nothing(spark, tmp_dir):
    base = f"{tmp_dir}/torn"
    v = load(spark, base, 1)
    open(f"{base}/_manifest/{2:020d}.json", "w").close()
    assert P.current_version(spark, base) == v
    assert load(spark, base, 2) == P.current_version(spark, base) and versions.current(spark, base)["number"] == 3


# ------------------------------------------------------- footers and pruning

def test_bounds_come_from_footers(spark, stored):
    base, _ = stored
    df = stored_range(spark, f"{base}/events")
    text = plan(df)
    assert re.search(r"PushedAggregation: \[MIN\(event_date\), MAX\(event_date\), COUNT\(\*\)\]", text), text
    events = spark.read.parquet(f"{base}/events")
    assert tuple(df.first()) == tuple(events.agg(F.min("event_date"), F.max("event_date"), F.count("*")).first())
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false", "the caller's session stays as it is"


def test_bounds_replace_the_scan_for_the_last_month(static, stored):
    base, _ = stored
    events, plans = static.read.parquet(f"{base}/events"), static.read.parquet(f"{base}/plans")
    customers = static.read.parquet(f"{base}/customers")
    bounds = MonthBounds(static, f"{base}/events")
    for build in (lambda **k: M.movements(events, customers, plans, **k),
                  lambda **k: asof_snapshot(events, "2000-05-01", customers, plans, **k),
                  lambda **k: monthly_rollup(events, customers, **k)):
        scans = [plan(build(**k)).count("/events]") for k in ({}, {"end": bounds.end()})]
        assert scans[1] == 1 < scans[0]
        assert rows(build()) == rows(build(end=bounds.end()))
    assert rows(bounds.spine()) == rows(M.month_spine(events)) and rows(bounds.options()) == rows(K.month_options(events))
    assert (bounds.first_month, bounds.last_month) == tuple(M.month_bounds(events).first()) and bounds.n_rows == events.count()


def test_bounds_without_events(spark, tmp_dir):
    spark.createDataFrame([], S.EVENTS).write.parquet(f"{tmp_dir}/none")
    bounds = MonthBounds(spark, f"{tmp_dir}/none")
    assert (bounds.first_month, bounds.last_month, bounds.n_rows) == (None, None, 0) and bounds.spine().count() == 0


def scanned_partitions(df):
    """Folders that the executed scan of the ledger read."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return [s.metrics().apply("numPartitions").value() for s in scans if s.metrics().contains("numPartitions") and s.metrics().contains("numFiles")]


@pytest.mark.parametrize("pick", [K.at_month, K.at_prior_month])
def test_only_the_months_folder_is_read(static, stored, tmp_dir, pick):
    base, _ = stored
    events = static.read.parquet(f"{base}/events")
    closes, customers = clustered(static, stored)
    P.write_ledger(M.movements_of_closes(closes, customers, static.read.parquet(f"{base}/plans")), f"{tmp_dir}/ledger")
    ledger = static.read.parquet(f"{tmp_dir}/ledger")
    month = F.add_months(M.last_month(events), -2)
    picked = pick(ledger, month).select("customer_id", "month_date", "current_mrr")
    got = rows(picked)
    assert scanned_partitions(picked) == [1] and len(glob.glob(f"{tmp_dir}/ledger/month_date=*")) > 50
    unpruned = pick(static.createDataFrame(ledger.toPandas(), ledger.schema), month).select("customer_id", "month_date", "current_mrr")
    assert got == rows(unpruned) and got


def test_a_ledger_by_year_has_the_same_rows_and_shuffles_no_dense_ones(spark, tmp_dir):
    days = ["2023-11-05", "2024-01-01", "2024-01-31", "2024-12-31", "2026-02-03"]
    rows = [(f"e{c}-{i}", f"cust_{c}", plan, "signup", day, i * 10 + c) for c in range(1, 4) for i, (day, plan) in
            enumerate(zip(days[c - 1:], ["plan_pro", None, "plan_basic", "plan_gone", "plan_pro"]))]
    events, customers, plans = H.events(spark, rows), H.customers(spark, ["cust_1", "cust_2", "cust_3"]), H.plans(spark)
    want = M.movements(events, customers, plans)
    seg = M.with_plan_names(M.segments(events, customers), plans)
    assert seg.count() < M.cut_by_year(seg).count() < want.count() / 2
    P.write_ledger(M.movements(events, customers, plans, by_year=True), f"{tmp_dir}/ledger", by_year=True)
    stored = spark.read.parquet(f"{tmp_dir}/ledger").select(*S.MOVEMENT_COLUMNS)
    assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect()))
    closes = M.movements_of_closes(M.month_close(events), customers, plans, by_year=True, partitions=3)
    assert sorted(map(str, closes.collect())) == sorted(map(str, want.collect()))
    plan = M.movements(events, customers, plans, by_year=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode(") < plan.index("RebalancePartitions"), "dense rows are made behind the shuffle by year"
