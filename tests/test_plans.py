"""Physical-plan guards: no cartesian products / nested-loop joins, scans pruned."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

SF001 = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_no_cross_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["agg1_commission_by_category"](spark, SF001))
    scan = [ln for ln in plan.splitlines() if "FileScan" in ln][0]
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in scan


def test_partial_aggregation_before_shuffle(spark):
    plan = _plan(E.queries()["agg5_customer_segments"](spark, SF001))
    assert "partial_sum" in plan and "partial_count" in plan


def test_rolling_window_partitioned_by_key_and_bucket(spark):
    plan = _plan(E.queries()["win6_rolling_merchant_count"](spark, SF001))
    assert "hashpartitioning(merchant_id" in plan and "__b" in plan.split("hashpartitioning(merchant_id")[1][:40]
