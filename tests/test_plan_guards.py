"""Scale guards on the physical plan of every registered query."""

from __future__ import annotations

import pytest

import __spark_entry__ as ent
from conftest import SF_SMALL
from ledgerline.plans import lake
from ledgerline.plans.registry import all_queries

FORBIDDEN = {
    "CartesianProduct": "cross join",
    "BroadcastNestedLoopJoin": "nested-loop join",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Python UDF",
    "FlatMapGroupsInPandas": "per-group Python",
    "MapInPandas": "Python over partitions",
    "MapInArrow": "Python over partitions",  # only to open files' footers
}


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_joins_or_python(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ent.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    found = [why for node, why in FORBIDDEN.items() if node in plan and not (name == "file_schemas" and node == "MapInArrow")]
    assert not found, f"{name}: {found}"


def test_date_filter_and_projection_reach_the_test_table_scan(spark):
    plan = ent.queries()["sales_by_country"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def _plan(spark, df, *off):
    for key in ("spark.sql.adaptive.enabled", *off):
        spark.conf.set(key, "false" if key.endswith("enabled") else "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for key in off:
            spark.conf.unset(key)


def test_landed_reads_prune_folders(spark):
    import os

    landed = lake.orders_partitioned(spark, SF_SMALL)
    folders = {tuple(f.split("/")[-3:-1]) for f in landed.inputFiles()}
    assert len(folders) > 25 and all(c.startswith("country=") and y.startswith("order_date_year=") for c, y in folders)
    plan = _plan(spark, lake.orders_partitioned_read(spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(order_date_year" in plan and "2000-01-01" in plan
    assert "PartitionFilters: [isnotnull(ship_date_month" in _plan(spark, lake.lineitem_pruned_read(spark, SF_SMALL))
    assert os.path.basename(landed.inputFiles()[0]).endswith(".snappy.parquet")


def test_bucketed_join_has_no_exchange_on_the_order(spark):
    from ledgerline.sources import catalog

    catalog.create_namespace(spark, "bucketed")
    try:
        plan = _plan(spark, lake.bucketed_revenue(spark, SF_SMALL, "bucketed"), "spark.sql.autoBroadcastJoinThreshold")
    finally:
        catalog.drop_namespace(spark, "bucketed")
    assert "SortMergeJoin" in plan and "hashpartitioning(order_id" not in plan


def test_integrity_check_reads_each_table_once(spark):
    plan = _plan(spark, all_queries()["orphans_all"](spark, SF_SMALL), "spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("l_orderkey") and sum("lineitem.parquet" in line for line in plan.splitlines() if "FileScan" in line) == 1
    assert sum("FileScan" in line for line in plan.splitlines()) == 7  # three children, four parents, no geography


def test_key_views_skip_the_geography(spark):
    for name in ("count_customers", "recent_orders", "orders_without_customer"):
        plan = _plan(spark, all_queries()[name](spark, SF_SMALL))
        assert "nation.parquet" not in plan and "region.parquet" not in plan, name
