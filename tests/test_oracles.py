"""Every registered query against its SQL twin, values and column names."""

import pytest
from compare import connect, rows_of_spark, rows_of_sql

from conftest import plan_of

from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = plan_of(df)
    # no pairs without a key, nothing row by row in Python
    for operator in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan
    columns, rows = rows_of_spark(df)
    sql_columns, sql_rows = rows_of_sql(con, ORACLES[name])
    assert columns == sql_columns
    assert rows, "the comparison would be empty"
    assert rows == sql_rows
