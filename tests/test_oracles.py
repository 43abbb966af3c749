import pytest
from conftest import SF
from oracle import compare, connect

import __spark_entry__ as entries
from tidemark.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLES.get(name)) is None


def test_entry(spark):
    assert entries.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entries.queries())
    assert set(ORACLES) <= set(entries.oracle_sql())
