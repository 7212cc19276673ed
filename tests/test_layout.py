"""Landing: conform, partitioned round trips, pruning, sort order, buckets, manifest."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline import specs
from ledgerline.operators.generate import generate
from ledgerline.sinks import layout

SIZES = {"customers": 300, "products": 200, "suppliers": 20, "orders": 2000, "lineitem": 3000,
         "inventory": 150, "events": 1000}


def _dirs(path):
    return sorted(d for d in os.listdir(path) if not d.startswith(("_", ".")))


@pytest.mark.parametrize("table", specs.TABLE_ORDER)
def test_round_trip_each_table(spark, tmp_root, table):
    df = generate(spark, table, SIZES[table], SIZES)
    path = os.path.join(tmp_root, table)
    rep = layout.write_table(df, path, table, granularity="day")
    assert rep["rows"] == SIZES[table]
    back = layout.read_table(spark, path, table)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in specs.spec(table).schema()]
    assert back.count() == SIZES[table]
    first = specs.spec(table).partition_cols[0]
    assert all(d.startswith(first + "=") for d in _dirs(path))
    cols = df.columns
    assert back.select(*cols).exceptAll(df.select(*cols)).count() == 0


def test_partition_filter_is_pruned(spark, tmp_root):
    df = generate(spark, "orders", SIZES["orders"], SIZES)
    path = os.path.join(tmp_root, "orders")
    layout.write_table(df, path, "orders")
    q = layout.read_table(spark, path).filter(F.col("order_date") >= F.lit(dt.date(2023, 6, 1)))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan and "2023-06-01" in plan
    assert q.count() == df.filter(F.col("order_date") >= F.lit(dt.date(2023, 6, 1))).count()


def test_projection_and_filter_reach_the_scan(spark, tmp_root):
    df = generate(spark, "lineitem", SIZES["lineitem"], SIZES)
    path = os.path.join(tmp_root, "lineitem")
    layout.write_table(df, path, "lineitem", layout="flat")
    q = layout.read_table(spark, path).filter(F.col("quantity") > 10).select("order_id", "net_amount")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(quantity), GreaterThan(quantity,10)]" in plan
    assert "ReadSchema: struct<order_id:bigint,quantity:int,net_amount:decimal(12,2)>" in plan


def test_month_granularity(spark, tmp_root):
    df = generate(spark, "orders", SIZES["orders"], SIZES)
    path = os.path.join(tmp_root, "orders_m")
    rep = layout.write_table(df, path, "orders", granularity="month")
    assert rep["partition_cols"] == ["country", "order_date_month"]
    sub = _dirs(os.path.join(path, _dirs(path)[0]))
    assert all(d.startswith("order_date_month=") and d.endswith("-01") for d in sub)
    assert layout.read_table(spark, path, "orders").count() == SIZES["orders"]
    with pytest.raises(ValueError):
        layout.write_table(df, path, "orders", granularity="week")


def test_sort_order_within_files(spark, tmp_root):
    """The declared sort order is applied inside each written file."""
    df = generate(spark, "lineitem", SIZES["lineitem"], SIZES)
    path = os.path.join(tmp_root, "li_sorted")
    layout.write_table(df, path, "lineitem", layout="flat")
    import pyarrow.parquet as pq

    for f in [x for x in os.listdir(path) if x.endswith(".parquet")]:
        t = pq.read_table(os.path.join(path, f), columns=["order_id", "lineitem_id"]).to_pylist()
        keys = [(r["order_id"], r["lineitem_id"]) for r in t]
        assert keys == sorted(keys)


def test_overwrite_replaces_and_partition_rerun(spark, tmp_root):
    """Overwrite is the default; a partition re-run keeps the rest."""
    df = generate(spark, "events", SIZES["events"], SIZES)
    path = os.path.join(tmp_root, "events")
    layout.write_table(df, path, "events")
    layout.write_table(df, path, "events")
    assert layout.read_table(spark, path).count() == SIZES["events"]
    one_type = df.filter(F.col("event_type") == "click")
    layout.write_table(one_type, path, "events", replace="partitions")
    assert layout.read_table(spark, path).count() == SIZES["events"]
    layout.write_table(one_type, path, "events")  # whole-table overwrite
    assert layout.read_table(spark, path).count() == one_type.count()


def test_conform_casts_orders_and_fills_by_name_only(spark):
    schema = specs.spec("inventory").schema("lake")
    raw = spark.createDataFrame([(1, 2, 3, "US", 5, 6, 7, 8, 9.999)],
                                "inventory_id long, supplier_id long, product_id long, warehouse_location string, "
                                "quantity_on_hand long, quantity_allocated long, reorder_point long, "
                                "reorder_quantity long, unit_cost double")
    with pytest.raises(ValueError, match="missing"):
        layout.conform(raw, schema)
    absent = tuple(c for c in schema.fieldNames() if c not in raw.columns)
    out = layout.conform(raw, schema, fill=absent)
    assert out.columns == schema.fieldNames()
    row = out.first()
    assert row.unit_cost == __import__("decimal").Decimal("10.00")
    assert row.last_updated is None and row.created_at is None
    with pytest.raises(ValueError):
        layout.conform(raw.withColumn("extra", F.lit(1)), schema, fill=absent)
    assert layout.conform(raw.withColumn("extra", F.lit(1)), schema, allow_extra=True, fill=absent).columns == schema.fieldNames()


def test_missing_partition_column_raises(spark, tmp_root):
    df = generate(spark, "suppliers", 20, SIZES).drop("established_year")
    with pytest.raises(ValueError):
        layout.clustered(df, "suppliers")


def test_bucketed_tables_join_without_shuffle(spark, tmp_root):
    o = generate(spark, "orders", SIZES["orders"], SIZES)
    li = generate(spark, "lineitem", SIZES["lineitem"], SIZES)
    spark.sql("DROP TABLE IF EXISTS b_orders")
    spark.sql("DROP TABLE IF EXISTS b_lineitem")
    layout.write_bucketed(o, "b_orders", "order_id", 8, os.path.join(tmp_root, "b_orders"))
    layout.write_bucketed(li, "b_lineitem", "order_id", 8, os.path.join(tmp_root, "b_lineitem"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("b_lineitem").join(spark.table("b_orders"), "order_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == SIZES["lineitem"]
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS b_orders")
        spark.sql("DROP TABLE IF EXISTS b_lineitem")


def test_manifest_round_trip(spark, tmp_root):
    reps = [{"table": "orders", "rows": 10}, {"table": "lineitem", "rows": 40}]
    m = layout.manifest_row(tmp_root, 10, "base", reps, generated_at="2024-01-01T00:00:00")
    layout.write_manifest(spark, tmp_root, m)
    back = layout.read_manifest(spark, tmp_root)
    assert back == m
    assert set(back) >= {"generation_date", "target_size_gb", "tables", "root", "chunk_size", "data_format",
                         "compression"}
    assert back["chunk_size"] == 1_000_000 and back["table_rows"] == {"orders": 10, "lineitem": 40}


def test_layout_does_not_depend_on_size(spark, tmp_root):
    for rows in (20, 500):
        path = os.path.join(tmp_root, f"s{rows}")
        rep = layout.write_table(generate(spark, "suppliers", rows, SIZES), path, "suppliers")
        assert rep["partition_cols"] == ["country", "established_year"] and rep["rows"] == rows
        assert all(d.startswith("country=") for d in _dirs(path))
        assert layout.read_table(spark, path, "suppliers").count() == rows


def test_top_products_on_bucketed_tables_skips_the_big_shuffle(spark, tmp_root):
    """lineitem and orders bucketed on order_id: the big join reads both sides in place."""
    from ledgerline.plans import corpus

    sizes = {"customers": 300, "products": 100, "suppliers": 20, "orders": 2000, "lineitem": 6000}
    for t in ("orders", "lineitem"):
        spark.sql(f"DROP TABLE IF EXISTS bk_{t}")
        layout.write_bucketed(generate(spark, t, sizes[t], sizes), f"bk_{t}", "order_id", 8,
                              os.path.join(tmp_root, f"bk_{t}"))
    # At 100 TB orders are far above any broadcast size; the products are not.
    products = F.broadcast(generate(spark, "products", sizes["products"], sizes))
    tables = {"orders": spark.table("bk_orders"), "lineitem": spark.table("bk_lineitem"), "products": products}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = corpus.top_products(lambda t: tables[t])
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert len(df.collect()) == 20
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("orders", "lineitem"):
            spark.sql(f"DROP TABLE IF EXISTS bk_{t}")
    join_part = plan[plan.index("SortMergeJoin"):] if "SortMergeJoin" in plan else ""
    assert join_part, plan
    # No hash exchange on order_id feeds the join: both sides keep their buckets.
    assert "hashpartitioning(order_id" not in plan


def test_bucketed_write_one_file_per_bucket(spark, tmp_root):
    df = generate(spark, "orders", 5000, SIZES, rows_per_partition=500)  # 10 input partitions
    spark.sql("DROP TABLE IF EXISTS b_files")
    path = os.path.join(tmp_root, "b_files")
    layout.write_bucketed(df, "b_files", "order_id", 4, path)
    try:
        files = [f for f in os.listdir(path) if f.endswith(".parquet")]
        assert len(files) == 4
        assert spark.table("b_files").count() == 5000
    finally:
        spark.sql("DROP TABLE IF EXISTS b_files")


def test_coarse_date_folders_are_pruned_and_sorted_by_date(spark, tmp_root):
    from ledgerline.plans import corpus

    sizes = {"customers": 300, "orders": 4000}
    path = os.path.join(tmp_root, "orders_y")
    layout.write_table(generate(spark, "orders", 4000, sizes), path, "orders", granularity="year")
    cust = generate(spark, "customers", 300, sizes)
    tables = {"orders": spark.read.parquet(path), "customers": cust}
    q = corpus.sales_by_country(lambda t: tables[t], since="2023-03-15")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date_year" in plan and "2023-01-01" in plan
    expected = tables["orders"].filter(F.col("order_date") >= F.lit(dt.date(2023, 3, 15))).count()
    assert q.agg(F.sum("order_count")).first()[0] == expected
    import pyarrow.parquet as pq

    for root_dir, _, files in os.walk(path):
        for f in [x for x in files if x.endswith(".parquet")]:
            dates = pq.read_table(os.path.join(root_dir, f), columns=["order_date"]).column(0).to_pylist()
            assert dates == sorted(dates)  # clustered by date inside each coarse folder
