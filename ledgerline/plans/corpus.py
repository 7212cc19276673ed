"""The published query corpus, as DataFrame plans over the retail model.

Every function takes ``tables``: a callable from a model table name to a
DataFrame.  The same plans therefore run over the mapped test tables,
over generated tables, or over a landed lake.

Plans are written declaratively and left to Catalyst/AQE: filters and
projections reach the Parquet scans, joins are chosen from runtime sizes
(no forced broadcast), and every ``LIMIT`` has a total tie-break order.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.aggregates import exact_avg, long_sum, money_sum, revenue_column, revenue_sum

Tables = Callable[[str], DataFrame]



def columns_of(tables: Tables, name: str, *columns: str) -> DataFrame:
    """These columns of a table.  A ``tables`` that takes a second argument is told
    them, so a mapped table need not join what nobody asks for."""
    if "columns" in inspect.signature(tables).parameters:
        return tables(name, columns=columns)
    return tables(name).select(*columns)


PUBLISHED_CUTOFF = "2024-01-01"


def _since(df: DataFrame, column: str, since: str) -> DataFrame:
    from ledgerline.sinks.layout import date_at_least

    return date_at_least(df, column, since)


def ltv_by_country_region(tables: Tables) -> DataFrame:
    """K1: average lifetime value and head count per (country, region)."""
    return (tables("customers")
            .groupBy("country", "region")
            .agg(exact_avg("lifetime_value").alias("avg_ltv"),
                 F.count(F.lit(1)).alias("customer_count"))
            .orderBy(F.desc("avg_ltv"), "country", "region"))


def top_products(tables: Tables, k: int = 20, approx_rsd: float | None = None) -> DataFrame:
    """K2: top-k product names by revenue, with units and distinct buyers.

    lineitem is joined to products and orders on their keys.  The distinct
    count is planned by Spark as a partial aggregate on
    (name, category, customer) before the final shuffle, so a hot product
    name never sends its raw rows to one task.  With ``approx_rsd`` the
    distinct buyers are a HyperLogLog estimate with that relative standard
    deviation: one sketch per group, no (name, category, customer) shuffle.
    """
    p = tables("products").select("product_id", "product_name", "category")
    li = tables("lineitem")
    rev = revenue_column(li)
    li = li.select("product_id", "order_id", "quantity", rev)
    o = tables("orders").select("order_id", "customer_id")
    return (p.join(li, "product_id").join(o, "order_id")
            .groupBy("product_name", "category")
            .agg(long_sum("quantity").alias("total_sold"),
                 revenue_sum(rev).alias("total_revenue"),
                 (F.countDistinct("customer_id") if approx_rsd is None
                  else F.approx_count_distinct("customer_id", approx_rsd)).alias("unique_customers"))
            .orderBy(F.desc("total_revenue"), "product_name", "category")
            .limit(k))


def count_rows(tables: Tables, table: str) -> DataFrame:
    """K3: ``SELECT COUNT(*)`` of one table."""
    from ledgerline import specs

    return columns_of(tables, table, specs.spec(table).key).agg(F.count(F.lit(1)).alias("row_count"))


def customers_by_country(tables: Tables) -> DataFrame:
    """K4."""
    return (tables("customers").groupBy("country")
            .agg(F.count(F.lit(1)).alias("customer_count"))
            .orderBy(F.desc("customer_count"), "country"))


def sales_by_country(tables: Tables, since: str = PUBLISHED_CUTOFF) -> DataFrame:
    """K5: order totals per customer country since a date.

    The date filter is typed, so it is pushed into the orders scan (and is a
    partition filter on a landed lake partitioned by order_date).
    """
    # orders have a country of their own: keep only what the join needs
    o = _since(tables("orders"), "order_date", since).select("order_id", "customer_id", "total_amount")
    # one row per customer and task in the shuffle, however many orders a customer has
    per_customer = o.groupBy("customer_id").agg(F.sum("total_amount").alias("amount"), F.count("order_id").alias("orders"))
    c = columns_of(tables, "customers", "customer_id", "country")
    return (per_customer.join(c, "customer_id")
            .groupBy("country")
            .agg(money_sum("amount").alias("total_sales"),
                 F.sum("orders").alias("order_count"))
            .orderBy(F.desc("total_sales"), "country"))


def revenue_by_category(tables: Tables, since: str = PUBLISHED_CUTOFF) -> DataFrame:
    """K7: revenue and line count per product category since a ship date."""
    li = tables("lineitem")
    rev = revenue_column(li)
    li = _since(li, "ship_date", since).select("lineitem_id", "product_id", rev)
    p = tables("products").select("product_id", "category")
    return (li.join(p, "product_id")
            .groupBy("category")
            .agg(revenue_sum(rev).alias("revenue"),
                 F.count("lineitem_id").alias("line_count"))
            .orderBy(F.desc("revenue"), "category"))


def table_row_counts(tables: Tables, names: tuple[str, ...] = ("customers", "orders")) -> DataFrame:
    """K8: one (table_name, row_count) row per table, by UNION ALL."""
    parts = [count_rows(tables, n).select(F.lit(n).alias("table_name"), "row_count") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orders_without_customer(tables: Tables) -> DataFrame:
    """K9: orders whose customer does not exist.

    The published text is LEFT JOIN ... WHERE c.customer_id IS NULL; null
    customer ids count as orphans, as in that form.  Orders are first
    counted per customer id (map-side partial aggregate), so a customer
    with a third of all orders costs one row per task in the shuffle, and
    the join to the customer keys sees unique keys on both sides.
    """
    from ledgerline.operators.quality import orphans
    from ledgerline.specs import Relation

    rel = Relation("orders", "customer_id", "customers", "customer_id")
    return orphans(tables, rel).select(F.col("orphans").alias("orphan_count"))


def recent_orders(tables: Tables, since: str = PUBLISHED_CUTOFF, k: int = 10) -> DataFrame:
    """Order id, amount and customer name of recent orders (first k by id).

    Orders are tried in ascending ranges of ids until k rows have a customer:
    a range's upper id comes from a top-k over the ids (k rows a task), and
    its bound is a filter that reaches the scan, so row groups beyond it are
    skipped and a handful of orders meets the customers.  Only where that
    many orders dangle does a further, ten times wider range follow.
    """
    o = _since(tables("orders"), "order_date", since).select("order_id", "customer_id", "total_amount").where("order_id IS NOT NULL")
    c = columns_of(tables, "customers", "customer_id", "customer_name")
    width, last = 10 * k, None
    while True:
        beyond = o if last is None else o.where(F.col("order_id") > last)
        edge = beyond.select("order_id").orderBy("order_id").limit(width).agg(F.max("order_id").alias("last"), F.count(F.lit(1)).alias("n")).first()
        last = edge["last"] if edge["n"] == width else None  # None: that range was the last
        tried = o if last is None else o.where(F.col("order_id") <= last)
        found = tried.join(c, "customer_id").select("order_id", "total_amount", "customer_name").orderBy("order_id", "customer_name").limit(k)
        if last is None or found.count() == k:
            return found
        width *= 10


def recent_orders_all_columns(tables: Tables, since: str = PUBLISHED_CUTOFF, k: int = 10) -> DataFrame:
    """``SELECT * FROM orders WHERE order_date >= ... LIMIT k`` (first k by id)."""
    o = tables("orders")
    return _since(o, "order_date", since).select(*[c for c in o.columns if not c.startswith("order_date_")]) \
        .orderBy("order_id").limit(k)
