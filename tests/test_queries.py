"""Every registered query against its SQL, on the smallest test tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import connect, difference
from tableflow.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert len(set(df.columns)) == len(df.columns)
    assert difference(df, duck, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_entry(spark):
    assert entry(spark).count() > 0
