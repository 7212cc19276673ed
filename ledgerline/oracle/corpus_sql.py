"""DuckDB text for the published corpus over the mapped test tables.

The model mapping is written again here as CTEs (``m_*``) so the oracle
does not share code with the Spark side.
"""

from __future__ import annotations

MODEL_CTES = """
WITH geo AS (
  SELECT n_nationkey, n_name AS country, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
), m_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, country, region, c_acctbal AS lifetime_value
  FROM customer JOIN geo ON c_nationkey = n_nationkey
), m_suppliers AS (
  SELECT s_suppkey AS supplier_id, s_name AS supplier_name, country, region, s_acctbal AS account_balance
  FROM supplier JOIN geo ON s_nationkey = n_nationkey
), m_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM part
), m_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_orderstatus AS order_status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
  FROM orders
), m_lineitem AS (
  SELECT CAST(l_linenumber AS BIGINT) AS lineitem_id, l_orderkey AS order_id, l_partkey AS product_id,
         l_suppkey AS supplier_id, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
           * (1 + CAST(l_tax AS DECIMAL(4,2))) AS net_amount,
         l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem
), m_events AS (
  SELECT event_id, user_id AS customer_id, event_type, ts AS event_timestamp, value
  FROM events
)
"""

CUTOFF = "2000-01-01"


def _q(body: str) -> str:
    return MODEL_CTES + body


CORPUS_SQL = {
    "ltv_by_country_region": _q("""
SELECT country, region,
       CAST(SUM(CAST(lifetime_value AS DECIMAL(14,2))) AS DOUBLE) / COUNT(lifetime_value) AS avg_ltv,
       COUNT(*) AS customer_count
FROM m_customers GROUP BY country, region ORDER BY avg_ltv DESC, country, region
"""),
    "top_products": _q("""
SELECT p.product_name, p.category,
       CAST(SUM(l.quantity) AS BIGINT) AS total_sold,
       CAST(SUM(l.net_amount) AS DECIMAL(18,2)) AS total_revenue,
       COUNT(DISTINCT o.customer_id) AS unique_customers
FROM m_products p
JOIN m_lineitem l ON p.product_id = l.product_id
JOIN m_orders o ON l.order_id = o.order_id
GROUP BY p.product_name, p.category
ORDER BY total_revenue DESC, p.product_name, p.category
LIMIT 20
"""),
    "count_customers": _q("SELECT COUNT(*) AS row_count FROM m_customers"),
    "count_orders": _q("SELECT COUNT(*) AS row_count FROM m_orders"),
    "customers_by_country": _q("""
SELECT country, COUNT(*) AS customer_count FROM m_customers GROUP BY country ORDER BY customer_count DESC, country
"""),
    "sales_by_country": _q(f"""
SELECT c.country, CAST(SUM(o.total_amount) AS DECIMAL(18,2)) AS total_sales, COUNT(o.order_id) AS order_count
FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id
WHERE o.order_date >= DATE '{CUTOFF}'
GROUP BY c.country ORDER BY total_sales DESC, c.country
"""),
    "revenue_by_category": _q(f"""
SELECT p.category, CAST(SUM(l.net_amount) AS DECIMAL(18,2)) AS revenue, COUNT(l.lineitem_id) AS line_count
FROM m_lineitem l JOIN m_products p ON l.product_id = p.product_id
WHERE l.ship_date >= '{CUTOFF}'
GROUP BY p.category ORDER BY revenue DESC, p.category
"""),
    "table_row_counts": _q("""
SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM m_customers
UNION ALL
SELECT 'orders', COUNT(*) FROM m_orders
"""),
    "orders_without_customer": _q("""
SELECT COUNT(*) AS orphan_count
FROM m_orders o LEFT JOIN m_customers c ON o.customer_id = c.customer_id
WHERE c.customer_id IS NULL
"""),
    "recent_orders": _q(f"""
SELECT o.order_id, o.total_amount, c.customer_name
FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id
WHERE o.order_date >= DATE '{CUTOFF}'
ORDER BY o.order_id, c.customer_name
LIMIT 10
"""),
    "recent_orders_all_columns": _q(f"""
SELECT * FROM m_orders WHERE order_date >= DATE '{CUTOFF}' ORDER BY order_id LIMIT 10
"""),
}
