"""DuckDB text for the landing, catalog and file queries, and for the wider use cases."""

from __future__ import annotations

from ledgerline.oracle.corpus_sql import MODEL_CTES
from ledgerline.oracle.extra_sql import TYPE_NAMES

SINCE = "2000-01-01"


def _q(body: str) -> str:
    return MODEL_CTES + body


_MICROS = """SUM(CAST(round(l_extendedprice * 100) AS HUGEINT) * (100 - CAST(round(l_discount * 100) AS HUGEINT))
  * (100 + CAST(round(l_tax * 100) AS HUGEINT)))"""


def _counted(name: str, table: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS planned_rows, count(*) AS actual_rows, TRUE AS ok FROM {table}"


def _file(table: str, columns: int) -> str:
    return f"SELECT '{table}' AS table_name, '{table}.parquet' AS file_name, {columns} AS columns, count(*) AS rows FROM {table}"


def funnel_sql(steps: list[str]) -> str:
    """Per step, customers whose first event of its type is not before the step before."""
    ctes, rows = [], []
    for i, step in enumerate(steps, start=1):
        if i == 1:
            ctes.append(f"r1 AS (SELECT user_id, min(ts) AS at FROM events WHERE event_type = '{step}' AND user_id IS NOT NULL GROUP BY user_id)")
        else:
            ctes.append(f"r{i} AS (SELECT e.user_id, min(e.ts) AS at FROM events e JOIN r{i - 1} p ON e.user_id = p.user_id "
                        f"WHERE e.event_type = '{step}' AND e.ts >= p.at GROUP BY e.user_id)")
        rows.append(f"SELECT {i} AS step_no, '{step}' AS step, count(*) AS users FROM r{i}")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(rows)


LAKE_SQL = {
    "orders_partitioned_read": _q(f"""
SELECT o.order_id, o.customer_id, o.order_date, o.order_status, o.total_amount, c.country
FROM m_orders o LEFT JOIN m_customers c ON o.customer_id = c.customer_id WHERE o.order_date >= DATE '{SINCE}'"""),
    "lineitem_pruned_read": _q(f"""
SELECT ship_date, CAST(SUM(CAST(net_amount AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS revenue,
  CAST(SUM(quantity) AS BIGINT) AS units, count(*) AS line_count
FROM m_lineitem WHERE ship_date >= DATE '{SINCE}' GROUP BY 1"""),
    "events_daily_read": """
SELECT CAST(ts AS DATE) AS event_date, count(*) AS purchases, min(ts) AS first_at, max(event_id) AS last_id
FROM events WHERE event_type = 'purchase' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' GROUP BY 1""",
    "revenue_of_large_months": _q("""
SELECT CAST(date_trunc('month', ship_date) AS DATE) AS ship_date_month, CAST(SUM(CAST(net_amount AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS revenue, count(*) AS line_count
FROM m_lineitem WHERE date_trunc('month', ship_date) IN (SELECT date_trunc('month', order_date) FROM m_orders WHERE total_amount >= 499700) GROUP BY 1"""),
    "orders_rerun": _q("""
SELECT c.country, CAST(year(order_date) AS INTEGER) AS order_year, count(*) AS orders,
  CAST(sum(total_amount + CASE WHEN year(order_date) = 1998 THEN 1.00 ELSE 0.00 END) AS DECIMAL(18,2)) AS amount,
  year(order_date) = 1998 AS rewritten, year(order_date) <> 1998 AS untouched
FROM m_orders o LEFT JOIN m_customers c ON o.customer_id = c.customer_id GROUP BY ALL"""),
    "landed_order": _q("""
SELECT CAST(date_trunc('month', ship_date) AS DATE) AS ship_month, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order, min(ship_date) AS first_date, max(ship_date) AS last_date
FROM m_lineitem GROUP BY 1"""),
    "customers_per_month": _q("""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, count(*) AS orders, count(DISTINCT customer_id) AS customers, TRUE AS estimate_within
FROM m_orders GROUP BY 1"""),
    "sales_calendar": _q("""
, o AS (
  SELECT c.country, CAST(date_trunc('week', order_date) AS DATE) AS week_start, count(*) AS orders, sum(total_amount) AS amount
  FROM m_orders o LEFT JOIN m_customers c ON o.customer_id = c.customer_id GROUP BY ALL),
span AS (SELECT country, unnest(generate_series(min(week_start), max(week_start), INTERVAL 7 DAY)) AS week_start FROM o GROUP BY country)
SELECT country, CAST(week_start AS DATE) AS week_start, coalesce(orders, 0) AS orders, CAST(coalesce(amount, 0) AS DECIMAL(18,2)) AS amount,
  printf('%d-W%02d', isoyear(week_start), week(week_start)) AS week, CAST(week_start + INTERVAL 6 DAY AS DATE) AS week_end
FROM (SELECT country, CAST(week_start AS DATE) AS week_start FROM span) LEFT JOIN o USING (country, week_start)"""),
    "events_created_or_loaded": """
SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS events, TRUE AS listed, TRUE AS made_first, FALSE AS made_again FROM events GROUP BY ALL""",
    "landed_file_sizes": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS rows, TRUE AS bounded, TRUE AS filled, TRUE AS below_target FROM lineitem GROUP BY 1""",
    "published_top_products": _q("""
SELECT p.product_name, p.category, CAST(SUM(l.quantity) AS BIGINT) AS total_sold, SUM(l.net_amount) AS total_revenue, COUNT(DISTINCT o.customer_id) AS unique_customers
FROM m_products p JOIN m_lineitem l ON p.product_id = l.product_id JOIN m_orders o ON l.order_id = o.order_id
GROUP BY p.product_name, p.category ORDER BY total_revenue DESC LIMIT 20"""),
    "external_orders_by_status": """
SELECT o_orderstatus AS order_status, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS amount
FROM orders GROUP BY o_orderstatus""",
    "inserted_orders": _q("""
SELECT CAST(year(order_date) AS INTEGER) AS order_year, count(*) AS orders, CAST(sum(total_amount) AS DECIMAL(18,2)) AS amount,
  min(order_date) AS first_date, max(order_date) AS last_date FROM m_orders GROUP BY 1"""),
    "orders_with_added_column": _q(f"""
SELECT m.*, CASE WHEN m.order_date >= DATE '{SINCE}' THEN o.o_orderpriority END AS order_priority
FROM m_orders m JOIN orders o ON m.order_id = o.o_orderkey"""),
    "bucketed_revenue_by_status": f"""
SELECT o_orderstatus AS order_status, CAST({_MICROS} / CAST(1000000 AS DECIMAL(7,0)) AS DECIMAL(18,2)) AS revenue, count(*) AS line_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "published_customers_by_country": _q("SELECT country, COUNT(*) AS customer_count FROM m_customers GROUP BY country"),
    "published_table_row_counts": _q("SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM m_customers UNION ALL SELECT 'orders', COUNT(*) FROM m_orders"),
    "published_orders_without_customer": _q("""
SELECT COUNT(*) AS orphan_count FROM m_orders o LEFT JOIN m_customers c ON o.customer_id = c.customer_id WHERE c.customer_id IS NULL"""),
    "planned_vs_landed": " UNION ALL ".join(_counted(n, t) for n, t in (("customers", "customer"), ("products", "part"), ("orders", "orders"), ("lineitem", "lineitem"))),
    "customers_without_event": _q("""
SELECT 'customers' AS child, 'customer_id' AS "column", 'events' AS parent, count(*) AS checked,
  count(*) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM m_events WHERE customer_id IS NOT NULL)) AS orphans FROM m_customers"""),
    "customer_tiles": _q("""
SELECT customer_id, customer_name, country, lifetime_value, CAST(ntile(10) OVER (ORDER BY lifetime_value, customer_id) AS BIGINT) AS tile FROM m_customers"""),
}

LAKE_SQL["file_inventory"] = " UNION ALL ".join(_file(t, n) for t, n in (("customer", 5), ("orders", 6), ("lineitem", 11), ("events", 6)))
LAKE_SQL["columns_of_orders"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS filled, count(DISTINCT {c}) AS \"values\" FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))
_GIVEN = {"customers": "customer", "products": "part", "suppliers": "supplier", "orders": "orders", "lineitem": "lineitem", "events": "events"}
LAKE_SQL["run_report"] = " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS planned_rows, count(*) AS written_rows, count(*) AS actual_rows, 'year' AS granularity, TRUE AS ok, CAST(NULL AS VARCHAR) AS error FROM {t}"
    for n, t in _GIVEN.items())
LAKE_SQL["landed_manifest"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS rows, TRUE AS times_agree, TRUE AS keys_unique, TRUE AS unchanged FROM {_GIVEN[n]}" for n in ("customers", "orders", "events"))
LAKE_SQL["file_schemas"] = f"""
SELECT table_name, table_name || '.parquet' AS file_name, CAST(column_index AS INTEGER) AS ordinal, column_name, {TYPE_NAMES} AS data_type, TRUE AS agrees
FROM duckdb_columns() WHERE table_name IN ('customer', 'orders', 'lineitem', 'part', 'supplier', 'events')"""
LONG_FUNNEL = ["signup", "view", "click", "purchase", "error"] * 4
LAKE_SQL["funnel_long"] = funnel_sql(LONG_FUNNEL)
