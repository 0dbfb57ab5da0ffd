"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert differences(name, spark, SF_DIR, duck, QUERIES, ORACLE) == []


def test_twins_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < sum(r["duration"] for r in rows) <= 7_200
    densities = [r["selected_density"] for r in rows]
    assert densities == sorted(densities, reverse=True)
