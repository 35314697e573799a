"""Pages by position and SQL with bound values."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import metrics as K
from tidemark.plans.bound import run_sql, select_where
from tidemark.sources.pages import MOST_ROWS, behind, page_rows, read_page, read_pages, total_rows

ORDER = ["country", "name", "id"]


@pytest.fixture(scope="module")
def ledger(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "", None]), rng.choice(["x", "y", None, "x'; --"]), rng.randrange(100)) for i in range(237)]
    return spark.createDataFrame(rows, "id int, country string, name string, v int").repartition(5)


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((r[i] is not None, r[i] if r[i] is not None else 0) for i in (1, 2, 0)))


@pytest.mark.parametrize("size", [1, 10, 79, 237, 1000])
def test_pages_together_are_the_ledger(ledger, size):
    df = ledger if size > 5 else ledger.where("id < 12")
    pages = list(read_pages(df, ORDER, size))
    assert [tuple(r) for p in pages for r in p.rows] == ordered(df)
    assert all(len(p.rows) <= size for p in pages) and sum(len(p.rows) for p in pages) == total_rows(df)
    assert pages[-1].after is None


def test_a_page_is_a_top_k(ledger):
    first = read_page(ledger, ORDER, 10)
    plan = page_rows(ledger, ORDER, 10, first.after)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan


def test_position_reaches_the_scan(spark, ledger, tmp_dir):
    ledger.where("country is not null").write.parquet(f"{tmp_dir}/l")
    df = page_rows(spark.read.parquet(f"{tmp_dir}/l"), ORDER, 5, ("a", "y", 3))
    assert "GreaterThanOrEqual(country,a)" in df._jdf.queryExecution().executedPlan().toString()


def test_positions_and_sizes_are_checked(ledger):
    for size in (0, MOST_ROWS + 1):
        with pytest.raises(ValueError):
            page_rows(ledger, ORDER, size)
    with pytest.raises(ValueError):
        behind(ORDER, ("a",))
    assert read_page(ledger.limit(0), ORDER, 5).rows == []


# ------------------------------------------------------------------- bound SQL

@pytest.fixture(scope="module")
def view(ledger):
    ledger.createOrReplaceTempView("bound_test")
    return "bound_test"


HOSTILE = ["x'; --", "' OR 1=1 --", "\\", "x\\'", ":country", "%", "); DROP VIEW bound_test; --", "${x}", ""]


@pytest.mark.parametrize("value", HOSTILE)
def test_hostile_values_stay_values(spark, view, ledger, value):
    got = select_where(spark, view, equal={"name": value})
    assert ordered(got) == ordered(ledger.where(F.col("name") == F.lit(value)))
    got = select_where(spark, view, among={"name": [value, "y"]}, equal={"country": "a"})
    assert ordered(got) == ordered(ledger.where(F.col("name").isin(value, "y") & (F.col("country") == "a")))
    got = run_sql(spark, "SELECT * FROM bound_test WHERE name = :value OR country IN (:countries)", value=value, countries=[value])
    assert ordered(got) == ordered(ledger.where((F.col("name") == value) | (F.col("country") == value)))
    assert spark.catalog.tableExists("bound_test")


def test_equals_the_dataframe_filters(spark):
    rows = [(i, c, n, "C%d" % (i % 7)) for i, (c, n) in enumerate([("US", "Tech"), ("US", "Retail"), ("DE", "Tech"), (None, "Tech")] * 5)]
    df = spark.createDataFrame(rows, "id int, country string, industry string, customer_name string")
    df.createOrReplaceTempView("bound_segment")
    for countries in ([], ["US"], ["US", "DE"], ["XX"]):
        for industries in ([], ["Tech"]):
            for pattern in (None, "c[12]"):
                want = K.search_name(K.segment_filter(df, countries, industries), pattern)
                got = select_where(spark, "bound_segment", among={"country": countries, "industry": industries}, like={"customer_name": pattern})
                assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())


def test_lists_and_names_are_checked(spark, view):
    assert run_sql(spark, "SELECT * FROM bound_test WHERE name IN (:names)", names=[]).count() == 0
    assert select_where(spark, view, equal={"name": None}).where("name is not null").count() == 0
    assert select_where(spark, view, columns=["id"]).columns == ["id"]
    with pytest.raises(ValueError):
        run_sql(spark, "SELECT 1", names=["a"])
    for name in ("name = '' OR 1", "id`", "a b", ""):
        with pytest.raises(ValueError):
            select_where(spark, view, equal={name: 1})
        with pytest.raises(ValueError):
            select_where(spark, name)


def test_lists_are_pushed_into_scans(spark, ledger, tmp_dir):
    ledger.write.parquet(f"{tmp_dir}/v")
    spark.read.parquet(f"{tmp_dir}/v").createOrReplaceTempView("bound_stored")
    plan = select_where(spark, "bound_stored", among={"country": ["a", "b"]})._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(country, [a,b])]" in plan


def test_a_session_without_context_needs_the_shared_folder():
    """As under Spark Connect: there is no context to ask, and an empty folder would mean the root."""
    from tidemark.session import checkpoint_dir

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Remote:
        def __init__(self, **conf):
            self.conf = Conf(conf)

        @property
        def sparkContext(self):  # noqa: N802
            raise NotImplementedError

    with pytest.raises(RuntimeError, match="shared folder"):
        checkpoint_dir(Remote())
    assert checkpoint_dir(Remote(**{"spark.checkpoint.dir": "s3a://x/y"})) == "s3a://x/y"
