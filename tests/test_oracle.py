"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import workload
from tests.oracle import compare, connect

SMALL = entry.SMALL
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) <= set(QUERIES)
    assert not set(workload.QUERIES) - set(workload.ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    problem = compare(spark, con, SMALL, QUERIES[name], ORACLES[name])
    assert problem is None, problem
