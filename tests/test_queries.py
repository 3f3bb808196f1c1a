"""Every registered query against its SQL in DuckDB."""

import sys

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])

import __spark_entry__ as driver  # noqa: E402
from compare import connection, differences  # noqa: E402
from snapmart_checks import REGISTRY  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = driver.queries(), {n: s for n, s in driver.oracle_sql().items() if n in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_every_query_has_sql():
    assert set(SQL) == set(REGISTRY)
    assert set(REGISTRY) <= set(QUERIES)


def test_entry(spark):
    result = driver.entry(spark)
    assert result.count() == 5
    assert result.columns[0] == "name"
