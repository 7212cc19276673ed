"""Named queries over a test-data folder: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline import specs
from ledgerline.operators import quality
from ledgerline.plans import corpus, usecases
from ledgerline.plans.lake import LAKE_QUERIES
from ledgerline.sources import catalog
from ledgerline.sources.driver_tables import model, read_raw

Query = Callable[[SparkSession, str], DataFrame]

# The published cut-off (2024) selects nothing from the test tables, whose
# orders end in 2001, so the driver queries use this date instead.
DRIVER_CUTOFF = "2000-01-01"


def driver_tables(spark: SparkSession, sf_dir: str) -> corpus.Tables:
    return lambda name, columns=None: model(spark, sf_dir, name, columns)


def _corpus(fn, **kw) -> Query:
    return lambda spark, sf_dir: fn(driver_tables(spark, sf_dir), **kw)


CORPUS_QUERIES: dict[str, Query] = {
    "ltv_by_country_region": _corpus(corpus.ltv_by_country_region),
    "top_products": _corpus(corpus.top_products),
    "count_customers": _corpus(corpus.count_rows, table="customers"),
    "count_orders": _corpus(corpus.count_rows, table="orders"),
    "customers_by_country": _corpus(corpus.customers_by_country),
    "sales_by_country": _corpus(corpus.sales_by_country, since=DRIVER_CUTOFF),
    "revenue_by_category": _corpus(corpus.revenue_by_category, since=DRIVER_CUTOFF),
    "table_row_counts": _corpus(corpus.table_row_counts),
    "orders_without_customer": _corpus(corpus.orders_without_customer),
    "recent_orders": _corpus(corpus.recent_orders, since=DRIVER_CUTOFF),
    "recent_orders_all_columns": _corpus(corpus.recent_orders_all_columns, since=DRIVER_CUTOFF),
}


# -- inspection (S3, S4) ------------------------------------------------------------

INSPECTED = ("customer", "orders", "lineitem", "part", "supplier", "events")
SAMPLED = ("customer", "orders", "lineitem", "events")


def _schema_of(name: str) -> Query:
    return lambda spark, sf_dir: catalog.inspect_schema(read_raw(spark, sf_dir, name))


def _sample_of(name: str) -> Query:
    return lambda spark, sf_dir: catalog.peek(spark, os.path.join(sf_dir, f"{name}.parquet"), 5)


INSPECTION_QUERIES: dict[str, Query] = {
    **{f"schema_of_{t}": _schema_of(t) for t in INSPECTED},
    **{f"sample_{t}": _sample_of(t) for t in SAMPLED},
}


# -- quality (Q3, Q4, Q5) -------------------------------------------------------------------

DRIVER_RELATIONS = [
    specs.Relation("lineitem", "order_id", "orders", "order_id"),
    specs.Relation("lineitem", "product_id", "products", "product_id"),
    specs.Relation("lineitem", "supplier_id", "suppliers", "supplier_id"),
    specs.Relation("orders", "customer_id", "customers", "customer_id"),
    specs.Relation("events", "customer_id", "customers", "customer_id"),
]

# Declared schema of the test lineitem table (what the mapping codes against).
LINEITEM_DECLARED = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz")


def orphans_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphans_all(driver_tables(spark, sf_dir), DRIVER_RELATIONS)


def schema_check_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.types import StructType

    expected = StructType.fromDDL(LINEITEM_DECLARED)
    return quality.schema_diff(spark, expected, read_raw(spark, sf_dir, "lineitem").schema)


def customers_without_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 for a relation with misses: customers that no event names."""
    relation = specs.Relation("customers", "customer_id", "events", "customer_id")
    return quality.orphans(driver_tables(spark, sf_dir), relation)


QUALITY_QUERIES: dict[str, Query] = {
    "orphans_all": orphans_all,
    "customers_without_event": customers_without_event,
    "schema_check_lineitem": schema_check_lineitem,
}


# -- use cases (C1-C8) --------------------------------------------------------------------

FUNNEL_STEPS = ["view", "click", "purchase"]
# so long that not every customer arrives
LONG_FUNNEL = ["signup", "view", "click", "purchase", "error"] * 4


def _use(fn, **kw) -> Query:
    return lambda spark, sf_dir: fn(driver_tables(spark, sf_dir), **kw)


USECASE_QUERIES: dict[str, Query] = {
    "segments": _use(usecases.segments),
    "customer_tiles": _use(usecases.customer_tiles),
    "category_stats": _use(usecases.category_stats),
    "supplier_scorecard": _use(usecases.supplier_scorecard),
    "sales_by_month_status": _use(usecases.sales_by_month_status),
    "sales_by_month_status_wide": _use(usecases.sales_by_month_status_wide, statuses=["F", "O", "P"]),
    "top3_per_category": _use(usecases.top3_per_category),
    "sessions": _use(usecases.sessions),
    "funnel": _use(usecases.funnel, steps=FUNNEL_STEPS),
    "funnel_long": _use(usecases.funnel, steps=LONG_FUNNEL),
}


def all_queries() -> dict[str, Query]:
    """Every registered query reads rows of the given tables."""
    return {**CORPUS_QUERIES, **INSPECTION_QUERIES, **QUALITY_QUERIES, **USECASE_QUERIES, **LAKE_QUERIES}


def all_oracle_sql() -> dict[str, str]:
    from ledgerline.oracle.corpus_sql import CORPUS_SQL
    from ledgerline.oracle.extra_sql import EXTRA_SQL
    from ledgerline.oracle.lake_sql import LAKE_SQL

    return {name: sql for name, sql in {**CORPUS_SQL, **EXTRA_SQL, **LAKE_SQL}.items() if name in all_queries()}
