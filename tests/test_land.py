"""The whole run: generate, land, report, manifest, and query the landed lake."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality
from ledgerline.plans import corpus
from ledgerline.sinks import layout
from ledgerline.sinks.land import land

SIZES = {"customers": 200, "products": 100, "suppliers": 10, "orders": 800, "lineitem": 2500,
         "inventory": 80, "events": 900}


@pytest.mark.parametrize("profile", ["lake", "base"])
def test_land_report_manifest_and_queries(spark, tmp_root, profile):
    rep = {r.table: r for r in land(spark, tmp_root, sizes=SIZES, profile=profile, granularity="year").collect()}
    assert set(rep) == set(SIZES)
    assert all(r.ok and r.actual_rows == SIZES[t] and r.files >= 1 for t, r in rep.items())
    m = layout.read_manifest(spark, tmp_root)
    assert m["table_rows"] == SIZES and m["profile"] == profile
    tables = lambda t: layout.read_table(spark, os.path.join(tmp_root, t))
    assert all(r.orphans == 0 for r in quality.orphans_all(tables).collect())
    top = corpus.top_products(tables).collect()
    assert 0 < len(top) <= 20
    if profile == "lake":
        assert rep["customers"].granularity == "year"
        assert set(os.listdir(os.path.join(tmp_root, "suppliers"))) > {d for d in os.listdir(os.path.join(tmp_root, "suppliers")) if d.startswith("country=")}
        since = corpus.sales_by_country(tables, since="2023-01-01")
        assert since.agg(F.sum("order_count")).first()[0] == \
            tables("orders").filter(F.col("order_date") >= "2023-01-01").count()


def test_land_by_size_and_subset(spark, tmp_root):
    rep = land(spark, tmp_root, size_gb=0.002, tables=["suppliers", "customers"], profile="base").collect()
    assert [r.table for r in rep] == ["customers", "suppliers"]  # generation order, not argument order
    assert {r.table: r.actual_rows for r in rep} == {"customers": 100, "suppliers": 40}


def test_land_rejects_bad_arguments(spark, tmp_root):
    with pytest.raises(ValueError):
        land(spark, tmp_root, sizes=SIZES, tables=["customers", "nope"])
    with pytest.raises(ValueError):
        land(spark, tmp_root)
    with pytest.raises(ValueError):
        land(spark, tmp_root, sizes=SIZES, on_error="retry")


def test_land_stops_or_continues_on_failure(spark, tmp_root):
    broken = {k: v for k, v in SIZES.items() if k != "suppliers"}  # products need the supplier count
    rep = land(spark, tmp_root, sizes=broken, tables=["customers", "products", "orders"], granularity="year", manifest=False).collect()
    assert [(r.table, r.ok) for r in rep] == [("customers", True), ("products", False)]
    assert "suppliers" in rep[1].error
    rep = land(spark, tmp_root, sizes=broken, tables=["customers", "products", "orders"], granularity="year", on_error="continue",
               manifest=False).collect()
    assert [(r.table, r.ok) for r in rep] == [("customers", True), ("products", False), ("orders", True)]


def test_every_plan_runs_on_a_landed_lake(spark, tmp_root):
    from ledgerline.plans import usecases

    land(spark, tmp_root, sizes=SIZES, profile="lake", granularity="year", manifest=False)
    tables = lambda t: layout.read_table(spark, os.path.join(tmp_root, t))
    plans = [
        corpus.ltv_by_country_region(tables), corpus.top_products(tables), corpus.count_rows(tables, "orders"),
        corpus.customers_by_country(tables), corpus.sales_by_country(tables, "2022-06-01"),
        corpus.revenue_by_category(tables, "2022-06-01"), corpus.table_row_counts(tables),
        corpus.orders_without_customer(tables), corpus.recent_orders(tables, "2022-06-01"),
        corpus.recent_orders_all_columns(tables, "2022-06-01"),
        usecases.segments(tables), usecases.category_stats(tables), usecases.supplier_scorecard(tables),
        usecases.sales_by_month_status(tables), usecases.top3_per_category(tables), usecases.reorder_alerts(tables),
        usecases.sessions(tables), usecases.funnel(tables, ["page_view", "add_to_cart", "purchase"]),
    ]
    counts = [p.count() for p in plans]
    assert all(c > 0 for c in counts), counts
    assert corpus.orders_without_customer(tables).first().orphan_count == 0
    assert usecases.supplier_scorecard(tables).agg(F.sum("lines")).first()[0] == SIZES["lineitem"]


def test_top_products_approximate_buyers(spark):
    from ledgerline.operators.generate import generate

    sizes = {"customers": 20000, "products": 50, "suppliers": 10, "orders": 60000, "lineitem": 120000}
    tables = lambda t: generate(spark, t, sizes[t], sizes)
    exact = {(r.product_name, r.category): r for r in corpus.top_products(tables).collect()}
    approx = {(r.product_name, r.category): r for r in corpus.top_products(tables, approx_rsd=0.02).collect()}
    assert exact.keys() == approx.keys()
    for key, e in exact.items():
        a = approx[key]
        assert (a.total_sold, a.total_revenue) == (e.total_sold, e.total_revenue)
        assert abs(a.unique_customers - e.unique_customers) <= 0.08 * e.unique_customers


def test_land_bucketed_join_tables(spark, tmp_root):
    rep = {r.table: r for r in land(spark, tmp_root, sizes=SIZES, tables=["customers", "orders", "lineitem"],
                                    buckets={"orders": ("order_id", 4), "lineitem": ("order_id", 4)},
                                    namespace="bk", manifest=False).collect()}
    assert rep["lineitem"].ok and rep["lineitem"].granularity == "bucket(4, order_id)"
    try:
        joined = spark.table("bk.lineitem").join(spark.table("bk.orders"), "order_id")
        assert joined.count() == SIZES["lineitem"]
    finally:
        spark.sql("DROP TABLE IF EXISTS bk.lineitem")
        spark.sql("DROP TABLE IF EXISTS bk.orders")
    with pytest.raises(ValueError):
        land(spark, tmp_root, sizes=SIZES, buckets={"orders": ("order_id", 4)})


def test_land_in_parallel_matches_sequential(spark, tmp_root):
    rep = land(spark, tmp_root, sizes=SIZES, profile="lake", granularity="year", parallel=4, manifest=False).collect()
    assert [r.table for r in rep] == list(specs_order())
    assert all(r.ok for r in rep)
    broken = {k: v for k, v in SIZES.items() if k != "suppliers"}
    rep = land(spark, tmp_root, sizes=broken, tables=["customers", "products", "orders"], granularity="year", parallel=3,
               on_error="continue", manifest=False).collect()
    assert [(r.table, r.ok) for r in rep] == [("customers", True), ("products", False), ("orders", True)]


def specs_order():
    from ledgerline import specs

    return specs.TABLE_ORDER


def test_concurrent_writes_of_one_table_count_their_own_rows(spark, tmp_root):
    from concurrent.futures import ThreadPoolExecutor

    from ledgerline.operators.generate import generate

    def write(n):
        df = generate(spark, "orders", n, {"customers": 50})
        return layout.write_table(df, os.path.join(tmp_root, f"o{n}"), "orders", layout="flat")["rows"]

    with ThreadPoolExecutor(max_workers=4) as pool:
        got = list(pool.map(write, [300, 500, 700, 900]))
    assert got == [300, 500, 700, 900]
