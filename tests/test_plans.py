"""What the physical plans of the queries must and must not hold."""

import os
import re

import pytest

import __spark_entry__ as contract
from gridtide.plans.queries import CATALOG

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# These run jobs to make their frame; their parts are planned like the batch queries.
EAGER = {name for name in CATALOG if name.startswith("stream_")} | {
    "bronze_landing_roundtrip",
    "bronze_all_fields",
    "pipeline_facts",
    "paged_windows",
    "rule_metrics_history",
    "order_dispatch",
    "stamped_layers",
    "watermark_run_time",
    "watermark_newest_reading",
}
LAZY = sorted(CATALOG.keys() - EAGER)


def plan_of(frame):
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text


@pytest.mark.parametrize("name", LAZY)
def test_no_costly_operators(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert operator not in plan
    # all rows in one partition: only for the few rows of a global aggregate
    for line in re.findall(r".*\n.*Exchange SinglePartition.*\n.*", plan):
        assert "Aggregate" in line


def test_fact_is_one_shuffle(spark):
    plan = plan_of(contract.queries()["fact_generation_latest"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("BroadcastHashJoin") == 2
    # of the events only the columns that are used are read
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_filters_reach_the_scan(spark):
    from gridtide.plans.feeds import event_feed

    plan = plan_of(event_feed(spark, SF_DIR, "click"))
    assert "EqualTo(event_type,click)" in plan


def test_profile_reads_pruned_json(spark):
    plan = plan_of(contract.queries()["dim_customer_type"](spark, SF_DIR))
    assert "from_json(StructField(CustomerType,StringType,true)," in plan
    assert "HashAggregate" in plan and "Window" not in plan
