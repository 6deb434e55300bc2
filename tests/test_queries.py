"""Every registered query: values against the reference SQL, and the shape of its plan."""

from __future__ import annotations

import pytest
from compare import connect, difference
from plans import physical

import __spark_entry__ as entry_point
from stratoform.catalog import all_queries

QUERIES = {name: q.build for name, q in all_queries().items()}
ORACLES = {name: q.sql for name, q in all_queries().items() if q.sql is not None}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = physical(df)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["region", "gender", "unique_customers", "total_revenue", "avg_purchase_amount"]
    assert df.count() == 25


def test_the_entry_point_has_every_query():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)
