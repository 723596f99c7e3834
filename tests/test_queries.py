import pytest

import __spark_entry__ as driver
from tests.oracle import compare, duck

from tidegate.plans.all_queries import QUERIES as PLAIN

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) <= set(QUERIES) and set(PLAIN) <= set(SQL)


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in PLAIN if not n.startswith(("stream", "flow", "queue_metrics"))))
def test_no_pairwise_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_are_narrow(spark, sf_dir):
    plan = plan_of(QUERIES["decompress_field"](spark, sf_dir))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan
    assert "url" not in plan.split("ReadSchema")[1].split("\n")[0]
