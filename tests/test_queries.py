"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference
from test_plans import plan

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def refuse_cross_joins(df):
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, connection, name):
    result = QUERIES[name](spark, FOLDER)
    refuse_cross_joins(result)
    assert difference(result, connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    result = QUERIES[name](spark, FOLDER)
    refuse_cross_joins(result)
    assert result.count() > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["qid", "answer", "prompt"]
    assert result.count() == 40
