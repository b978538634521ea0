"""Physical plans: pushed filters, pruned columns, limited windows, checked broadcasts, and no pair-wise joins."""

import re

import pytest

import __spark_entry__ as entry
from tierloom.operators import joins
from tierloom.plans import testtables as tt
from tierloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


WRITES = {"incremental_delete_insert", "push_ingest", "push_offline", "stream_upsert_orders", "scan_text"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_latest_row_is_limited_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["latest_per_key"](spark, SF))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in plan_of(entry.queries()["retrieve_topk"](spark, SF))


def test_only_needed_columns_are_read(spark):
    plan = plan_of(entry.queries()["order_signals"](spark, SF))
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate", plan)
    assert "partial_" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan_of(
        entry.queries()["scan_parquet"](spark, SF))


def test_filters_reach_the_scan(spark):
    pushed = plan_of(entry.queries()["recent_customer_targets"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,2001-01-01T00:00", pushed)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(label,3\)", plan_of(entry.queries()["retrieve_filtered"](spark, SF)))


def test_broadcast_only_within_its_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, customers = tt.orders(spark, SF), tt.customers(spark, SF).select("customer_id", "customer_name")
        top = lambda df: plan_of(df)
        assert "BroadcastHashJoin [customer_id" in top(joins.enrich(orders, customers, "customer_id", broadcast=True))
        beyond = joins.enrich(orders, customers, "customer_id", broadcast=True, max_rows=10)
        assert "SortMergeJoin [customer_id" in top(beyond)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_scan_for_all_thresholds_and_row_checks(spark):
    assert plan_of(entry.queries()["dq_not_null"](spark, SF)).count("FileScan") == 1
    sweep = plan_of(entry.queries()["threshold_sweep"](spark, SF))
    assert sweep.count("orders.parquet") == 1


def test_hot_keys_of_a_join_are_split(spark):
    """The adaptive skew join cuts the partition of a hot customer on the order side."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        orders = spark.range(60_000, numPartitions=8).selectExpr(
            "id AS order_id", "IF(id % 3 = 0, 7, id % 1000) AS customer_id", "uuid() AS note")
        customers = spark.range(1000).selectExpr("id AS customer_id", "concat('c', id) AS customer_name")
        joined = joins.enrich(orders, customers, "customer_id")
        assert joined.count() == 60_000
        joined = joins.enrich(orders, customers, "customer_id")
        joined.collect()
        assert "skew" in plan_of(joined)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_few_but_wide_rows_are_not_broadcast(spark):
    wide = spark.range(200).selectExpr("id AS k", "repeat('x', 1000) AS note", "array(id, id) AS a")
    rows, size = joins.measured_size(wide)
    assert rows == 200 and 200_000 < size < 250_000
    assert "broadcast" in joins.broadcast_if_small(wide)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in joins.broadcast_if_small(wide, max_bytes=100_000)._jdf.queryExecution().logical().toString().lower()
    assert joins.measured_size(wide.limit(0)) == (0, 0)
