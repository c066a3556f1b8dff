"""Every query against the SQL that defines it, on the smallest data folder."""

import pytest

from conformance.check import difference, oracle_connection
from conformance.oracle import oracle_sql
from conformance.queries import QUERIES
from conformance.views import VIEWS, with_views

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql_without_a_pairwise_join(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, con, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_statement_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_view_is_the_same_in_both_engines(spark, con, name):
    from conformance.shapes import Given

    assert difference(Given(spark, SF_DIR).table(name), con, with_views(f"select * from {name}")) is None


def test_entry(spark):
    import __spark_entry__ as driver

    docs = driver.entry(spark)
    assert docs.columns[0] == "variant_id" and docs.count() == 200
