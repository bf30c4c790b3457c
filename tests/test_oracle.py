"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import connect, rows_of_spark, rows_of_sql

from clickloom.plans.oracle import all_sql
from clickloom.plans.queries import all_queries

QUERIES = all_queries()
SQL = all_sql()

# Plans must not need any of these: no cross products, no Python per row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
            "MapInPandas", "FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    names, expected = rows_of_sql(con, SQL[name])
    assert sorted(result.columns) == names
    found = rows_of_spark(result)
    assert found == expected
    assert found
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "event_name"
