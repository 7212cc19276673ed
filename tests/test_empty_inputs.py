"""Every plan runs on empty tables and returns empty results or zero counts."""

from __future__ import annotations

import pytest

from ledgerline import specs
from ledgerline.operators import quality
from ledgerline.plans import corpus, usecases


@pytest.fixture(scope="module")
def empty(spark):
    frames = {t: spark.createDataFrame([], specs.spec(t).schema("lake")) for t in specs.TABLE_ORDER}
    return lambda t: frames[t]


PLANS = {
    "ltv_by_country_region": (lambda t: corpus.ltv_by_country_region(t), []),
    "top_products": (lambda t: corpus.top_products(t), []),
    "count_rows": (lambda t: corpus.count_rows(t, "orders"), [(0,)]),
    "customers_by_country": (lambda t: corpus.customers_by_country(t), []),
    "sales_by_country": (lambda t: corpus.sales_by_country(t), []),
    "revenue_by_category": (lambda t: corpus.revenue_by_category(t), []),
    "table_row_counts": (lambda t: corpus.table_row_counts(t), [("customers", 0), ("orders", 0)]),
    "orders_without_customer": (lambda t: corpus.orders_without_customer(t), [(0,)]),
    "recent_orders": (lambda t: corpus.recent_orders(t), []),
    "recent_orders_all_columns": (lambda t: corpus.recent_orders_all_columns(t), []),
    "segments": (lambda t: usecases.segments(t), []),
    "category_stats": (lambda t: usecases.category_stats(t), []),
    "supplier_scorecard": (lambda t: usecases.supplier_scorecard(t), []),
    "sales_by_month_status": (lambda t: usecases.sales_by_month_status(t), []),
    "sales_by_month_status_wide": (lambda t: usecases.sales_by_month_status_wide(t, specs.ORDER_STATUSES), []),
    "top3_per_category": (lambda t: usecases.top3_per_category(t), []),
    "reorder_alerts": (lambda t: usecases.reorder_alerts(t), []),
    "sessions": (lambda t: usecases.sessions(t), []),
    "funnel": (lambda t: usecases.funnel(t, ["page_view", "click"]), [(1, "page_view", 0), (2, "click", 0)]),
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_plan_on_empty_tables(empty, name):
    build, expected = PLANS[name]
    rows = sorted(tuple(r) for r in build(empty).collect())
    assert rows == sorted(expected)


def test_quality_on_empty_tables(empty):
    res = quality.orphans_all(empty).collect()
    assert len(res) == len(specs.RELATIONS) and all((r.checked, r.orphans) == (0, 0) for r in res)
    counts = quality.row_counts(empty, specs.TABLE_ORDER).collect()
    assert all(r.row_count == 0 for r in counts)
