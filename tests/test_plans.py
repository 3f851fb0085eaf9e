"""Plan checks on the registered queries and the oracle gate at sf0.01."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

from salesnet.oracle import oracle_sql
from salesnet.plans.registry import all_queries

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

QUERIES = all_queries()
ORACLE = oracle_sql()


def plan_of(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cartesian_product_or_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"


def test_window_filter_reaches_the_scan_and_columns_are_pruned(spark):
    plan = plan_of(QUERIES["revenue_by_zone"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in plan
    assert "LessThan(o_orderdate,1999-01-01T00:00)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan


def test_promotion_join_only_when_needed(spark):
    # Jobs that only ask whether a line was promoted never join lines to parts.
    plan = plan_of(QUERIES["distributor_scorecard"](spark, SF))
    assert "part.parquet" not in plan


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).df())
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["zone_name", "distributor_name", "total_revenue", "latest_mom_growth_percentage",
                          "promotion_participation_rate", "zone_rank"]
