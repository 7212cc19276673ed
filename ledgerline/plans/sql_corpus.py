"""The published query texts, runnable with ``spark.sql`` on registered tables.

Register a landed lake with :func:`ledgerline.sources.catalog.register_lake`
and switch to its namespace (``USE spark_catalog.<ns>``); the bare table
names in the texts then resolve, and three-part names
(``spark_catalog.<ns>.customers``) work as well.  The texts are kept as
published; the DataFrame plans in :mod:`ledgerline.plans.corpus` add total
tie-break orders where a ``LIMIT`` needs one.

The time-travel text (``... FOR SYSTEM_TIME AS OF '...'``) needs a table
format connector, which is not available here.

On a lake landed with coarsened date folders (``order_date_month`` or
``order_date_year``), a SQL filter on
``order_date`` alone skips row groups by statistics but not folders; add
the same bound on the folder column (``AND order_date_year >= DATE
'2024-01-01'``) to prune folders, as the DataFrame plans do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The published query texts (bare table names).
PUBLISHED_SQL = {
    "ltv_by_country_region": """
SELECT
    country,
    region,
    AVG(lifetime_value) as avg_ltv,
    COUNT(*) as customer_count
FROM customers
GROUP BY country, region
ORDER BY avg_ltv DESC""",
    "top_products": """
SELECT
    p.product_name,
    p.category,
    SUM(l.quantity) as total_sold,
    SUM(l.net_amount) as total_revenue,
    COUNT(DISTINCT o.customer_id) as unique_customers
FROM products p
JOIN lineitem l ON p.product_id = l.product_id
JOIN orders o ON l.order_id = o.order_id
GROUP BY p.product_name, p.category
ORDER BY total_revenue DESC
LIMIT 20""",
    "count_customers": "SELECT COUNT(*) FROM customers",
    "count_orders": "SELECT COUNT(*) FROM orders",
    "customers_by_country": """
SELECT country, COUNT(*) as customer_count
FROM customers
GROUP BY country
ORDER BY customer_count DESC""",
    "sales_by_country": """
SELECT
    c.country,
    SUM(o.total_amount) as total_sales,
    COUNT(o.order_id) as order_count
FROM orders o
JOIN customers c ON o.customer_id = c.customer_id
WHERE o.order_date >= DATE '2024-01-01'
GROUP BY c.country
ORDER BY total_sales DESC""",
    "revenue_by_category": """
SELECT
    p.category,
    SUM(l.net_amount) as revenue,
    COUNT(l.lineitem_id) as line_count
FROM lineitem l
JOIN products p ON l.product_id = p.product_id
WHERE l.ship_date >= '2024-01-01'
GROUP BY p.category
ORDER BY revenue DESC""",
    "table_row_counts": """
SELECT
    'customers' as table_name, COUNT(*) as row_count FROM customers
UNION ALL
SELECT 'orders', COUNT(*) FROM orders""",
    "orders_without_customer": """
SELECT COUNT(*)
FROM orders o
LEFT JOIN customers c ON o.customer_id = c.customer_id
WHERE c.customer_id IS NULL""",
    "recent_orders": """
SELECT o.order_id, o.total_amount, c.customer_name
FROM orders o
JOIN customers c ON o.customer_id = c.customer_id
WHERE o.order_date >= DATE '2024-01-01'
LIMIT 10""",
    "recent_orders_all_columns": "SELECT * FROM orders WHERE order_date >= DATE '2024-01-01' LIMIT 10",
}


def run_published(spark: SparkSession, name: str, namespace: str, catalog: str = "spark_catalog") -> DataFrame:
    """Run one published text against the tables registered in ``namespace``."""
    spark.sql(f"USE {catalog}.{namespace}")
    return spark.sql(PUBLISHED_SQL[name])
