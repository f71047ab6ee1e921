"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from tidelog import plans


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(plans.ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    problem, _ = differences(spark, sf_dir, con, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_lag" in df.columns
