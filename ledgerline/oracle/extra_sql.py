"""DuckDB text for inspection, quality and use-case queries."""

from __future__ import annotations

from ledgerline.oracle.corpus_sql import MODEL_CTES
from ledgerline.oracle.generators_sql import generator_sql

TYPE_NAMES = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date'
  WHEN 'BOOLEAN' THEN 'boolean' WHEN 'FLOAT' THEN 'float' ELSE lower(data_type) END"""


def _schema_of(table: str) -> str:
    return f"""
SELECT CAST(column_index AS INTEGER) AS ordinal, column_name, {TYPE_NAMES} AS data_type, is_nullable AS nullable
FROM duckdb_columns() WHERE table_name = '{table}'
"""


_SAMPLE_ORDER = {
    "customer": "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment",
    "orders": "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
    "lineitem": ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
                 "l_tax, l_returnflag, l_linestatus, l_shipdate"),
    "events": "event_id, ts, user_id, event_type, value, props",
}


def _sample(table: str) -> str:
    return f"SELECT * FROM {table} ORDER BY {_SAMPLE_ORDER[table]} LIMIT 5"


def _orphans(child: str, col: str, parent: str, pcol: str) -> str:
    return f"""
SELECT '{child[2:]}' AS child, '{col}' AS "column", '{parent[2:]}' AS parent,
       CAST(COUNT(*) AS BIGINT) AS checked, CAST(COUNT(*) FILTER (WHERE p.k IS NULL) AS BIGINT) AS orphans
FROM {child} c LEFT JOIN (SELECT DISTINCT {pcol} AS k FROM {parent}) p ON c.{col} = p.k"""


ORPHANS_SQL = MODEL_CTES + " UNION ALL ".join([
    _orphans("m_lineitem", "order_id", "m_orders", "order_id"),
    _orphans("m_lineitem", "product_id", "m_products", "product_id"),
    _orphans("m_lineitem", "supplier_id", "m_suppliers", "supplier_id"),
    _orphans("m_orders", "customer_id", "m_customers", "customer_id"),
    _orphans("m_events", "customer_id", "m_customers", "customer_id"),
])

_LINEITEM_DECLARED = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]

SCHEMA_CHECK_SQL = f"""
WITH expected AS (
  SELECT * FROM (VALUES {", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(_LINEITEM_DECLARED, start=1))})
    AS v(ordinal, column_name, expected)
), actual AS (
  SELECT column_name, {TYPE_NAMES} AS actual FROM duckdb_columns() WHERE table_name = 'lineitem'
)
SELECT CAST(e.ordinal AS INTEGER) AS ordinal, e.column_name, e.expected, a.actual,
       CASE WHEN a.actual IS NULL THEN 'missing' WHEN a.actual = e.expected THEN 'ok' ELSE 'type_mismatch' END AS status
FROM expected e LEFT JOIN actual a ON a.column_name = e.column_name
"""

SEGMENTS_SQL = MODEL_CTES + """
, t AS (SELECT customer_id, lifetime_value, ntile(4) OVER (ORDER BY lifetime_value, customer_id) AS segment
        FROM m_customers)
SELECT CAST(segment AS BIGINT) AS segment, COUNT(*) AS customers, MIN(lifetime_value) AS min_ltv,
       MAX(lifetime_value) AS max_ltv,
       CAST(SUM(CAST(lifetime_value AS DECIMAL(14,2))) AS DOUBLE) / COUNT(lifetime_value) AS avg_ltv
FROM t GROUP BY segment
"""

CATEGORY_STATS_SQL = MODEL_CTES + """
SELECT category, COUNT(*) AS products, COUNT(DISTINCT brand) AS brands,
       CAST(SUM(CAST(price AS DECIMAL(14,2))) AS DOUBLE) / COUNT(price) AS avg_price,
       MIN(price) AS min_price, MAX(price) AS max_price
FROM m_products GROUP BY category
"""

SUPPLIER_SCORECARD_SQL = MODEL_CTES + """
, per AS (
  SELECT supplier_id, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS revenue, CAST(SUM(quantity) AS BIGINT) AS units,
         COUNT(*) AS lines, COUNT(DISTINCT product_id) AS products
  FROM m_lineitem GROUP BY supplier_id)
SELECT per.supplier_id, revenue, units, lines, products, s.supplier_name, s.country
FROM per JOIN m_suppliers s ON per.supplier_id = s.supplier_id
"""

SALES_BY_MONTH_STATUS_SQL = MODEL_CTES + """
SELECT CAST(year(order_date) * 100 + month(order_date) AS BIGINT) AS month_key, order_status,
       COUNT(*) AS orders, CAST(SUM(total_amount) AS DECIMAL(18,2)) AS amount
FROM m_orders GROUP BY 1, 2
"""

TOP3_SQL = MODEL_CTES + """
, rev AS (SELECT product_id, CAST(SUM(net_amount) AS DECIMAL(18,2)) AS revenue FROM m_lineitem GROUP BY product_id),
ranked AS (
  SELECT p.category, r.product_id, p.product_name, r.revenue,
         row_number() OVER (PARTITION BY p.category ORDER BY r.revenue DESC, r.product_id) AS rnk
  FROM rev r JOIN m_products p ON r.product_id = p.product_id)
SELECT category, CAST(rnk AS BIGINT) AS rank, product_id, product_name, revenue FROM ranked WHERE rnk <= 3
"""

REORDER_ALERTS_SQL = f"""
WITH inv AS ({generator_sql("inventory", "lake")})
SELECT inventory_id, product_id, supplier_id, warehouse_location,
       CAST(quantity_on_hand - quantity_allocated AS BIGINT) AS available,
       CAST(reorder_point AS BIGINT) AS reorder_point, CAST(reorder_quantity AS BIGINT) AS reorder_quantity,
       CAST(CAST(reorder_quantity AS DECIMAL(10,0)) * unit_cost AS DECIMAL(18,2)) AS reorder_cost
FROM inv WHERE quantity_on_hand - quantity_allocated <= reorder_point
"""

SESSIONS_SQL = MODEL_CTES + """
, e AS (
  SELECT customer_id, event_timestamp, event_id,
         lag(event_timestamp) OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id) AS prev
  FROM m_events),
s AS (
  SELECT *, SUM(CASE WHEN prev IS NULL OR event_timestamp - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
              OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id ROWS UNBOUNDED PRECEDING) AS sno
  FROM e)
SELECT customer_id, CAST(sno AS BIGINT) AS session_no, MIN(event_timestamp) AS session_start,
       MAX(event_timestamp) AS session_end, COUNT(*) AS events
FROM s GROUP BY customer_id, sno
"""

FUNNEL_SQL = MODEL_CTES + """
, s1 AS (SELECT customer_id, MIN(event_timestamp) AS t FROM m_events WHERE event_type = 'view' GROUP BY customer_id),
s2 AS (SELECT e.customer_id, MIN(e.event_timestamp) AS t FROM m_events e JOIN s1 ON e.customer_id = s1.customer_id
       WHERE e.event_type = 'click' AND e.event_timestamp >= s1.t GROUP BY e.customer_id),
s3 AS (SELECT e.customer_id, MIN(e.event_timestamp) AS t FROM m_events e JOIN s2 ON e.customer_id = s2.customer_id
       WHERE e.event_type = 'purchase' AND e.event_timestamp >= s2.t GROUP BY e.customer_id)
SELECT 1 AS step_no, 'view' AS step, COUNT(*) AS users FROM s1
UNION ALL SELECT 2, 'click', COUNT(*) FROM s2
UNION ALL SELECT 3, 'purchase', COUNT(*) FROM s3
"""

EXTRA_SQL: dict[str, str] = {
    **{f"schema_of_{t}": _schema_of(t) for t in ("customer", "orders", "lineitem", "part", "supplier", "events")},
    **{f"sample_{t}": _sample(t) for t in _SAMPLE_ORDER},
    "orphans_all": ORPHANS_SQL,
    "schema_check_lineitem": SCHEMA_CHECK_SQL,
    "segments": SEGMENTS_SQL,
    "category_stats": CATEGORY_STATS_SQL,
    "supplier_scorecard": SUPPLIER_SCORECARD_SQL,
    "sales_by_month_status": SALES_BY_MONTH_STATUS_SQL,
    "top3_per_category": TOP3_SQL,
    "sessions": SESSIONS_SQL,
    "funnel": FUNNEL_SQL,
}


def _wide(table: str, statuses: list[str]) -> str:
    cols = ",\n       ".join(
        f"COUNT(*) FILTER (WHERE order_status = '{s}') AS {s}_orders, "
        f"CAST(SUM(total_amount) FILTER (WHERE order_status = '{s}') AS DECIMAL(18,2)) AS {s}_amount"
        for s in statuses)
    return (f"SELECT CAST(year(order_date) * 100 + month(order_date) AS BIGINT) AS month_key,\n       {cols}\n"
            f"FROM {table} GROUP BY 1")


EXTRA_SQL["sales_by_month_status_wide"] = MODEL_CTES + _wide("m_orders", ["F", "O", "P"])
