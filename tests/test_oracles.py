"""Every registered query outside the optional subpackage gives what its SQL gives, at the smallest scale."""

import pytest

from tallgrass.plans import registry
from tests.oracle import connect, rows

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_each_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) and registry.FLAGSHIP in QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name in SQL:
        want = con.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got.columns) == len(set(got.columns))
