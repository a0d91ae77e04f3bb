"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SQL = oracle_sql()
TEXT = tuple(n for n in queries() if n == "pipeline" or n[:2] == "op" and n[2:3].isdigit())  # tests of their own


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


# All pairs of two tables, or rows through Python one batch at a time: never needed by a query.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", [n for n in queries() if n in SQL])
def test_matches_sql(spark, sf_dir, con, name):
    df = queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
    problem, rows = difference(df, con, SQL[name])
    assert problem is None
    assert rows > 0 or name == "duplicate_keys"


@pytest.mark.parametrize("name", [n for n in queries() if n not in SQL and n not in TEXT])
def test_runs(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 1503
