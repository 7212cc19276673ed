"""Quality checks on hand-made fixtures: nulls, dangling keys, empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from ledgerline.operators import quality
from ledgerline.plans import corpus
from ledgerline.specs import Relation


@pytest.fixture()
def tables(spark):
    data = {
        "customers": spark.createDataFrame([(1, "a"), (2, "b")], "customer_id long, customer_name string"),
        "orders": spark.createDataFrame([(10, 1), (11, None), (12, 99), (13, 2), (14, 99)],
                                        "order_id long, customer_id long"),
        "empty": spark.createDataFrame([], "customer_id long"),
    }
    return lambda name: data[name]


def test_orphans_counts_null_and_dangling(tables):
    r = quality.orphans(tables, Relation("orders", "customer_id", "customers", "customer_id")).first()
    assert (r.checked, r.orphans) == (5, 3)  # one null and two rows with key 99
    r = quality.orphans(tables, Relation("orders", "customer_id", "customers", "customer_id", nullable=True)).first()
    assert (r.checked, r.orphans) == (4, 2)


def test_published_orphan_query_agrees(tables):
    assert corpus.orders_without_customer(tables).first().orphan_count == 3


def test_orphans_on_empty_tables(tables):
    r = quality.orphans(tables, Relation("empty", "customer_id", "customers", "customer_id")).first()
    assert (r.checked, r.orphans) == (0, 0)
    r = quality.orphans(tables, Relation("orders", "customer_id", "empty", "customer_id")).first()
    assert (r.checked, r.orphans) == (5, 5)


def test_orphans_pre_aggregate_before_the_join(spark, tables):
    df = quality.orphans(tables, Relation("orders", "customer_id", "customers", "customer_id"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # child keys are counted map-side first


def test_row_counts_and_completeness(spark, tables):
    counts = quality.row_counts(tables, ["customers", "orders", "empty"])
    got = {r.table_name: r.row_count for r in counts.collect()}
    assert got == {"customers": 2, "orders": 5, "empty": 0}
    res = {r.table_name: r for r in quality.completeness(spark, {"customers": 2, "orders": 6, "lost": 3},
                                                          counts).collect()}
    assert res["customers"].ok and not res["orders"].ok
    assert res["lost"].actual_rows == 0 and not res["lost"].ok  # D14: a missing table is a failure


def test_schema_diff(spark):
    exp = T.StructType.fromDDL("a bigint, b string, c int")
    act = T.StructType.fromDDL("a bigint, b int, d date")
    rows = {r.column_name: r.status for r in quality.schema_diff(spark, exp, act).collect()}
    assert rows == {"a": "ok", "b": "type_mismatch", "c": "missing", "d": "unexpected"}
