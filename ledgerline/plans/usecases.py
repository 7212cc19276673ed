"""Analytics named by the published use cases (C1-C8), over the retail model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.aggregates import exact_avg, long_sum, money_sum, revenue_column, revenue_sum
from ledgerline.operators.windows import global_ntile, ordered_funnel, sessionize, top_k_per_group

Tables = Callable[[str], DataFrame]


def segments(tables: Tables, k: int = 4) -> DataFrame:
    """Customers in k lifetime-value tiles (``ntile`` by value, then id),
    with head count and value range per tile."""
    c = tables("customers").select("customer_id", "lifetime_value")
    tiled = global_ntile(c, ["lifetime_value", "customer_id"], k, out="segment")
    return (tiled.groupBy("segment")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.min("lifetime_value").alias("min_ltv"),
                 F.max("lifetime_value").alias("max_ltv"),
                 exact_avg("lifetime_value").alias("avg_ltv"))
            .withColumn("segment", F.col("segment").cast("bigint")))


def customer_tiles(tables: Tables, k: int = 10) -> DataFrame:
    """C1, per customer: the lifetime-value tile beside name and country."""
    c = tables("customers").select("customer_id", "customer_name", "country", "lifetime_value")
    tiled = global_ntile(c, ["lifetime_value", "customer_id"], k)
    return tiled.withColumn("tile", F.col("tile").cast("bigint"))


def category_stats(tables: Tables) -> DataFrame:
    """Per category: products, distinct brands, average/min/max price."""
    return (tables("products").groupBy("category")
            .agg(F.count(F.lit(1)).alias("products"),
                 F.countDistinct("brand").alias("brands"),
                 exact_avg("price").alias("avg_price"),
                 F.min("price").alias("min_price"),
                 F.max("price").alias("max_price")))


def supplier_scorecard(tables: Tables) -> DataFrame:
    """Per supplier: revenue, units, lines and distinct products.

    lineitem is aggregated to one row per supplier before the join with
    the supplier dimension, so the join sees one row per supplier.
    """
    li = tables("lineitem")
    if "supplier_id" not in li.columns:  # generated lineitem: the supplier comes with the product
        li = li.join(tables("products").select("product_id", "supplier_id"), "product_id")
    per_supplier = (li.groupBy("supplier_id")
                    .agg(revenue_sum(revenue_column(li)).alias("revenue"),
                         long_sum("quantity").alias("units"),
                         F.count(F.lit(1)).alias("lines"),
                         F.countDistinct("product_id").alias("products")))
    s = tables("suppliers").select("supplier_id", "supplier_name", "country")
    return per_supplier.join(s, "supplier_id")


def sales_by_month_status(tables: Tables) -> DataFrame:
    """C4: orders and amount per (year*100+month, status), long form."""
    o = tables("orders")
    month = (F.year("order_date") * 100 + F.month("order_date")).cast("bigint")
    return (o.groupBy(month.alias("month_key"), "order_status")
            .agg(F.count(F.lit(1)).alias("orders"), money_sum("total_amount").alias("amount")))


def sales_by_month_status_wide(tables: Tables, statuses: list[str]) -> DataFrame:
    """C4, wide: one row per month, ``<status>_orders`` and ``<status>_amount``
    columns for a fixed status list (no extra pass to find the values).

    Spark pre-aggregates (month, status) and pivots those few rows.
    Months without a status get 0 orders and a null amount.
    """
    o = tables("orders")
    month = (F.year("order_date") * 100 + F.month("order_date")).cast("bigint")
    wide = (o.groupBy(month.alias("month_key")).pivot("order_status", statuses)
            .agg(F.count(F.lit(1)).alias("orders"), money_sum("total_amount").alias("amount")))
    return wide.select("month_key", *[c for s in statuses for c in (
        F.coalesce(F.col(f"{s}_orders"), F.lit(0)).alias(f"{s}_orders"), F.col(f"{s}_amount"))])


def top3_per_category(tables: Tables, k: int = 3) -> DataFrame:
    """The k products with most revenue in each category (ties by id)."""
    li = tables("lineitem")
    revenue = li.groupBy("product_id").agg(revenue_sum(revenue_column(li)).alias("revenue"))
    p = tables("products").select("product_id", "product_name", "category")
    ranked = top_k_per_group(revenue.join(p, "product_id"), ["category"], [F.desc("revenue"), F.asc("product_id")], k)
    return ranked.select("category", "rank", "product_id", "product_name", "revenue")


def reorder_alerts(tables: Tables) -> DataFrame:
    """Stock rows at or below their reorder point, with order cost.

    available = on hand - allocated (may be negative); cost of the reorder
    = reorder quantity * unit cost.  A filter and a projection: no shuffle.
    """
    inv = tables("inventory")
    available = (F.col("quantity_on_hand") - F.col("quantity_allocated")).cast("bigint")
    return (inv.withColumn("available", available)
            .filter(F.col("available") <= F.col("reorder_point"))
            .select("inventory_id", "product_id", "supplier_id", "warehouse_location", "available",
                    F.col("reorder_point").cast("bigint").alias("reorder_point"),
                    F.col("reorder_quantity").cast("bigint").alias("reorder_quantity"),
                    (F.col("reorder_quantity").cast("decimal(10,0)") * F.col("unit_cost"))
                    .cast("decimal(18,2)").alias("reorder_cost")))


def sessions(tables: Tables, gap_seconds: int = 1800) -> DataFrame:
    """30-minute-gap sessions per customer: start, end and event count."""
    ev = tables("events").select("customer_id", "event_timestamp", "event_id")
    numbered = sessionize(ev, "customer_id", "event_timestamp", "event_id", gap_seconds)
    return (numbered.groupBy("customer_id", "session_no")
            .agg(F.min("event_timestamp").alias("session_start"),
                 F.max("event_timestamp").alias("session_end"),
                 F.count(F.lit(1)).alias("events")))


def funnel(tables: Tables, steps: list[str]) -> DataFrame:
    """Customers reaching each step in order."""
    ev = tables("events").select("customer_id", "event_timestamp", "event_type")
    return ordered_funnel(ev, "customer_id", "event_timestamp", "event_type", steps)
