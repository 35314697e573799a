"""Every registered query against its DuckDB oracle (sf0.001), plus the entry smoke."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(entry._QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_broken_data_has_violations(con):
    """The rows that the checks over defective data are compared with are not all zero."""
    for name, sql in entry.oracle_sql().items():
        if name.endswith("_broken") and "violations" in (rel := con.sql(sql)).columns:
            assert con.execute(f"SELECT sum(violations) FROM ({sql})").fetchall()[0][0] > 0, name


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "ending_mrr" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert r["values_match"] and r["types_match"], r
