"""Plan shape: no cartesian or nested-loop joins, one aggregation exchange on the key
per history table in the wide build, pruned Parquet scans."""

import re

import pytest

import __spark_entry__ as E
from cohortforge.plans.registry import QUERIES
SF001 = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("oof_", "naive_bayes"))])
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_wide_plan_prunes_columns(spark):
    df = E.queries()["wide_features"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas, plan[:500]
    for s in schemas:
        assert "l_comment" not in s and "props" not in s and "l_partkey" not in s


def test_wide_plan_shuffles_a_history_once_by_its_key(spark):
    plan = _plan(E.queries()["wide_features"](spark, SF001)).split("InMemoryRelation")[0]
    by_user = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    # card and POS balance: one aggregate each on the customer key
    assert plan.count("MONTHS_BALANCE") and by_user.count("c_custkey") <= 8


@pytest.mark.parametrize("name", ["latest_category", "latest_on_mean_key", "prev_mode", "wide_features"])
def test_histories_are_not_aggregated_by_sorting(spark, name):
    """Latest rows and modal categories use hash aggregates with fixed-width buffers."""
    plan = _plan(QUERIES[name](spark, SF001)).split("InMemoryRelation")[0]
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("name", ["latest_on_mean_key", "wide_features"])
def test_balance_rows_are_reduced_for_the_mean_ids_alone(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi, (l_orderkey" in plan[plan.index("Aggregate [l_orderkey"):]


def test_cardinalities_without_expand(spark):
    plan = _plan(QUERIES["cardinality_profile"](spark, SF001))
    assert "HashAggregate" in plan and "Expand" not in plan


def test_wide_build_reads_the_balance_rows_of_the_mean_ids_once(spark):
    from cohortforge.plans.registry import QUERIES
    plan = QUERIES["wide_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    reads = [x for x in plan.splitlines() if "Project" in x and "l_orderkey" in x and "l_quantity" in x and "l_linestatus" in x and "l_shipdate" in x]
    assert len(reads) == 1
