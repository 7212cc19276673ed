"""DuckDB text that reproduces the generators row for row.

Written independently of the Spark recipes: the same contract (md5 draw
of ``"<id>:<seed>:<table>:<name>"``, 52 bits, fixed windows) expressed in
DuckDB's dialect.  Row counts are taken from the test tables, so the
oracle grows with them exactly like the Spark side.
"""

from __future__ import annotations

import datetime as dt
import math

from ledgerline import specs

TWO_52 = "4503599627370496.0::DOUBLE"

# Test table whose row count sizes each generated table.
SIZE_SOURCES = {
    "customers": "customer",
    "products": "part",
    "suppliers": "supplier",
    "orders": "orders",
    "lineitem": "lineitem",
    "inventory": "part",
    "events": "events",
}

WINDOWS = {
    "customers.registration": ("2020-01-01", "2024-01-01"),
    "customers.last_login.base": ("2023-01-01", "2024-01-01"),
    "customers.last_login.lake": ("2024-01-01", "2025-01-01"),
    "products.created": ("2019-01-01", "2024-01-01"),
    "suppliers.established": ("2000-01-01", "2020-01-01"),
    "orders": ("2022-01-01", "2024-01-01"),
    "lineitem": ("2022-01-01", "2024-01-01"),
    "inventory": ("2024-01-01", "2024-01-31"),
    "events": ("2024-01-01", "2024-01-31"),
}
HOUR, MINUTE, DAY = 3600, 60, 86400


def rows_sql(table: str) -> str:
    return f"GREATEST((SELECT count(*) FROM {SIZE_SOURCES[table]}), 1)"


def _dbl(x: float) -> str:
    return f"'{float(x)!r}'::DOUBLE"


def _lst(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


class Q:
    """SQL snippets for one table; mirrors the draw contract."""

    def __init__(self, table: str, profile: str, seed: int = 42):
        self.t, self.p, self.seed = table, profile, seed
        self.lake = profile == "lake"

    def key(self, name: str) -> str:
        return f"md5(CAST(id AS VARCHAR) || ':{self.seed}:{self.t}:{name}')"

    def h(self, name: str, part: int = 0) -> str:
        return f"CAST(('0x' || substr({self.key(name)}, {1 + 13 * part}, 13)) AS BIGINT)"

    def u(self, name: str, part: int = 0) -> str:
        return f"(CAST({self.h(name, part)} AS DOUBLE) / {TWO_52})"

    def choice(self, name: str, values: list[str]) -> str:
        return f"({_lst(values)})[CAST(({self.h(name)} % {len(values)}) AS BIGINT) + 1]"

    def bern(self, name: str, p: float) -> str:
        return f"({self.u(name)} < {_dbl(p)})"

    def normal(self, name: str, mean: float, sd: float) -> str:
        z = (f"(sqrt({_dbl(-2.0)} * ln({_dbl(1.0)} - {self.u(name, 0)})) * "
             f"cos({_dbl(2.0 * math.pi)} * {self.u(name, 1)}))")
        return f"({_dbl(mean)} + {_dbl(sd)} * {z})"

    def exp(self, name: str, mean: float) -> str:
        return f"({_dbl(-mean)} * ln({_dbl(1.0)} - {self.u(name)}))"

    def unif(self, name: str, lo: float, hi: float) -> str:
        return f"({_dbl(lo)} + {self.u(name)} * {_dbl(hi - lo)})"

    def below(self, name: str, lo: int, hi: int) -> str:
        return f"({lo} + ({self.h(name)} % {hi - lo}))"

    def between(self, name: str, lo: int, hi: int) -> str:
        return f"({lo} + ({self.h(name)} % {hi - lo + 1}))"

    def fk(self, name: str, parent: str) -> str:
        return f"(1 + ({self.h(name)} % {rows_sql(parent)}))"

    def nfk(self, name: str, parent: str) -> str:
        return f"NULLIF({self.h(name)} % ({rows_sql(parent)} + 1), 0)"

    @staticmethod
    def units(expr: str, k: int) -> str:
        """floor(x * 10^k + 0.5) as BIGINT (half-up rounding in double arithmetic)."""
        return f"CAST(floor(({expr}) * {_dbl(10 ** k)} + {_dbl(0.5)}) AS BIGINT)"

    @staticmethod
    def rhu(expr: str, k: int) -> str:
        """x rounded half up to k decimals, as DOUBLE."""
        return f"(floor(({expr}) * {_dbl(10 ** k)} + {_dbl(0.5)}) / {_dbl(10 ** k)})"

    @staticmethod
    def dec(units: str, precision: int) -> str:
        """Integer cents as DECIMAL(precision, 2), exactly."""
        return f"CAST(CAST({units} AS DECIMAL({precision},0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL({precision},2))"

    def money(self, expr: str, precision: int = 10) -> str:
        return self.dec(self.units(expr, 2), precision)

    def exp_money(self, name: str, mean: float, precision: int = 10) -> str:
        e = self.exp(name, mean)
        return self.money(e, precision) if self.lake else self.rhu(e, 2)

    def steps(self, window: str, step: int) -> tuple[str, int]:
        a, b = WINDOWS[window]
        span = int((dt.datetime.fromisoformat(b) - dt.datetime.fromisoformat(a)).total_seconds()) // step
        return a, span

    def ts(self, window: str, step: int) -> str:
        a, span = self.steps(window, step)
        return f"(TIMESTAMP '{a} 00:00:00' + to_seconds(((id - 1) % {span}) * {step}))"

    def date(self, window: str, step: int) -> str:
        a, span = self.steps(window, step)
        return f"(DATE '{a}' + CAST(((((id - 1) % {span}) * {step}) // 86400) AS INTEGER))"

    def even(self, window: str) -> str:
        a, b = WINDOWS[window]
        span = int((dt.date.fromisoformat(b) - dt.date.fromisoformat(a)).total_seconds())
        return (f"(DATE '{a}' + CAST(((((id - 1) * {span}) // GREATEST({rows_sql(self.t)} - 1, 1)) // 86400) "
                f"AS INTEGER))")

    @staticmethod
    def txt(*parts: str) -> str:
        return "(" + " || ".join(parts) + ")"

    @staticmethod
    def s(x: str) -> str:
        return f"CAST({x} AS VARCHAR)"

    def person(self, name: str) -> str:
        if self.lake:
            return self.txt("'Customer_'", self.s(self.between(name, 10000, 99999)))
        return self.txt("'Name_'", self.s(self.between(name, 1000, 9999)))

    def email(self, name: str) -> str:
        if self.lake:
            return self.txt("'user'", self.s(self.between(name, 10000, 99999)), "'@example.com'")
        return self.txt("'user'", "CAST(id AS VARCHAR)", "'@example.com'")

    def phone(self, name: str) -> str:
        return self.txt("'+1-'", self.s(self.between(name + ".a", 200, 999)), "'-'",
                        self.s(self.between(name + ".b", 100, 999)), "'-'",
                        self.s(self.between(name + ".c", 1000, 9999)))

    def address(self, name: str) -> str:
        street = self.choice(name + ".street", specs.STREET_WORDS) if self.lake else "'Main'"
        return self.txt(self.s(self.between(name + ".no", 1, 9999)), "' '", street, "' St, City '",
                        self.s(self.between(name + ".city", 1, 1000)))

    def audit(self, updated: bool = True) -> list[str]:
        if not self.lake:
            return []
        a = "TIMESTAMP '2024-01-01 00:00:00'"
        return [f"{a} AS created_at"] + ([f"{a} AS updated_at"] if updated else [])


def _customers(q: Q) -> list[str]:
    reg = q.date("customers.registration", HOUR) if q.lake else q.ts("customers.registration", HOUR)
    score = f"CAST(trunc({q.normal('credit_score', 650, 100)}) AS {'INTEGER' if q.lake else 'BIGINT'})"
    return [
        "id AS customer_id", f"{q.person('customer_name')} AS customer_name", f"{q.email('email')} AS email",
        f"{q.phone('phone')} AS phone", f"{q.address('address')} AS address",
        f"{q.choice('country', specs.COUNTRIES)} AS country", f"{q.choice('region', specs.REGIONS)} AS region",
        f"{reg} AS registration_date", f"{score} AS credit_score",
        f"{q.rhu(q.exp('lifetime_value', 500), 2)} AS lifetime_value",
        f"{q.bern('is_premium', 0.2)} AS is_premium",
        f"{q.ts('customers.last_login.' + q.p, HOUR)} AS last_login", *q.audit(),
    ]


def _products(q: Q) -> list[str]:
    if q.lake:
        name = q.txt("'Product_'", q.choice("product_name.word", specs.PRODUCT_WORDS),
                     q.s(q.between("product_name", 1, 100000)))
        brand = q.txt("'Brand_'", q.choice("brand.word", specs.BRAND_WORDS), q.s(q.between("brand", 1, 1000)))
        cost = q.money(f"({q.exp('cost', 50)} * {q.unif('cost.share', 0.3, 0.8)})")
        weight = f"CAST({q.rhu(q.exp('weight', 2), 2)} AS FLOAT)"
        desc = q.txt("'Product description for item '", q.s(q.between("description", 10000, 99999)))
        created = q.date("products.created", HOUR)
    else:
        name = q.txt("'Product_'", "CAST(id AS VARCHAR)")
        brand = q.txt("'Brand_'", q.s(q.between("brand", 1, 1000)))
        cost = q.rhu(f"{q.exp('cost', 50)} * {q.unif('cost.share', 0.3, 0.8)}", 6)
        weight = q.rhu(q.exp('weight', 2), 2)
        desc = q.txt("'Description for item '", "CAST(id AS VARCHAR)")
        created = q.ts("products.created", HOUR)
    dims = q.txt(q.s(q.between("dim.x", 1, 50)), "'x'", q.s(q.between("dim.y", 1, 50)), "'x'",
                 q.s(q.between("dim.z", 1, 50)))
    return [
        "id AS product_id", f"{name} AS product_name", f"{q.choice('category', specs.CATEGORIES)} AS category",
        f"{brand} AS brand", f"{q.exp_money('price', 50)} AS price", f"{cost} AS cost", f"{weight} AS weight",
        f"{dims} AS dimensions", f"{desc} AS description",
        f"{q.fk('supplier_id', 'suppliers')} AS supplier_id", f"{created} AS created_date",
        f"{q.bern('is_active', 0.8)} AS is_active", *q.audit(),
    ]


def _suppliers(q: Q) -> list[str]:
    rating = q.rhu(q.unif('rating', 1, 5), 1)
    if q.lake:
        name = q.txt("'Supplier_'", q.choice("supplier_name.word", specs.SUPPLIER_WORDS),
                     q.s(q.between("supplier_name", 1, 10000)))
        est = q.even("suppliers.established")
        extra = [f"CAST({rating} AS FLOAT) AS rating", f"{est} AS established_date",
                 f"CAST(year({est}) AS INTEGER) AS established_year"]
    else:
        name = q.txt("'Supplier_'", "CAST(id AS VARCHAR)")
        extra = [f"{rating} AS rating", f"{q.ts('suppliers.established', DAY)} AS established_date"]
    return [
        "id AS supplier_id", f"{name} AS supplier_name", f"{q.person('contact_name')} AS contact_name",
        f"{q.email('email')} AS email", f"{q.phone('phone')} AS phone", f"{q.address('address')} AS address",
        f"{q.choice('country', specs.COUNTRIES)} AS country", f"{q.choice('region', specs.REGIONS)} AS region",
        *extra, f"{q.bern('is_verified', 0.7)} AS is_verified", *q.audit(),
    ]


def _orders(q: Q) -> list[str]:
    if q.lake:
        od = q.even("orders")
        dates = [f"{od} AS order_date",
                 f"({od} + CAST({q.between('ship_days', 1, 3)} AS INTEGER)) AS ship_date",
                 f"({od} + CAST({q.between('delivery_days', 3, 10)} AS INTEGER)) AS delivery_date"]
        tax = q.money(f"({q.exp('tax_amount', 100)} * {_dbl(0.1)})")
    else:
        od = q.ts("orders", MINUTE)
        dates = [f"{od} AS order_date", f"({od} + INTERVAL 1 DAY) AS ship_date",
                 f"({od} + INTERVAL 4 DAY) AS delivery_date"]
        tax = q.rhu(f"{q.exp('tax_amount', 100)} * {_dbl(0.1)}", 6)
    return [
        "id AS order_id", f"{q.fk('customer_id', 'customers')} AS customer_id", *dates,
        f"{q.choice('order_status', specs.ORDER_STATUSES)} AS order_status",
        f"{q.choice('payment_method', specs.PAYMENT_METHODS)} AS payment_method",
        f"{q.exp_money('total_amount', 100, 12)} AS total_amount", f"{tax} AS tax_amount",
        f"{q.exp_money('shipping_amount', 10, 8)} AS shipping_amount",
        f"{q.exp_money('discount_amount', 5, 8)} AS discount_amount",
        f"{q.choice('country', specs.COUNTRIES)} AS country", f"{q.choice('region', specs.REGIONS)} AS region",
        *q.audit(),
    ]


def _lineitem(q: Q) -> list[str]:
    qty = q.below("quantity", 1, 20)
    unit_cents = q.units(q.exp('unit_price', 25), 2)
    unit = f"(CAST({unit_cents} AS DOUBLE) / {_dbl(100.0)})"
    disc = q.rhu(q.unif('discount', 0, 0.3), 3)
    tax = q.rhu(q.unif('tax', 0.05, 0.15), 3)
    if q.lake:
        gross = f"(CAST({qty} AS DOUBLE) * {unit})"
        money = [
            f"{q.dec(unit_cents, 10)} AS unit_price", f"CAST({disc} AS FLOAT) AS discount",
            f"CAST({tax} AS FLOAT) AS tax",
            f"{q.dec(f'({qty} * {unit_cents})', 12)} AS extended_price",
            q.money(f"({gross} * {q.unif('discount_amount', 0, 0.3)})") + " AS discount_amount",
            q.money(f"({gross} * {q.unif('tax_amount', 0.05, 0.15)})") + " AS tax_amount",
            q.money(f"({gross} * {q.unif('net_amount', 0.8, 1.2)})", 12) + " AS net_amount",
        ]
        ship = q.even("lineitem")
        comment = q.txt("'Comment '", q.s(q.between("comment", 100000, 999999)))
    else:
        money = [
            f"{unit} AS unit_price", f"{disc} AS discount", f"{tax} AS tax",
            q.rhu(f"CAST({q.below('extended_price.qty', 1, 20)} AS DOUBLE) * {q.exp('extended_price', 25)}", 6)
            + " AS extended_price",
            q.rhu(f"{q.exp('discount_amount.base', 25)} * {q.unif('discount_amount', 0, 0.3)}", 6)
            + " AS discount_amount",
            q.rhu(f"{q.exp('tax_amount.base', 25)} * {q.unif('tax_amount', 0.05, 0.15)}", 6) + " AS tax_amount",
            q.rhu(f"{q.exp('net_amount.base', 25)} * {q.unif('net_amount', 0.8, 1.2)}", 6) + " AS net_amount",
        ]
        ship = q.ts("lineitem", MINUTE)
        comment = q.txt("'Comment '", q.s(q.between("comment", 1, 1000000)))
    return [
        "id AS lineitem_id", f"{q.fk('order_id', 'orders')} AS order_id",
        f"{q.fk('product_id', 'products')} AS product_id",
        f"CAST({qty} AS {'INTEGER' if q.lake else 'BIGINT'}) AS quantity", *money,
        f"{q.choice('line_status', specs.LINE_STATUSES)} AS line_status", f"{ship} AS ship_date",
        f"{comment} AS comment", *q.audit(),
    ]


def _inventory(q: Q) -> list[str]:
    n = "INTEGER" if q.lake else "BIGINT"
    cols = [
        "id AS inventory_id", f"{q.fk('product_id', 'products')} AS product_id",
        f"{q.fk('supplier_id', 'suppliers')} AS supplier_id",
        f"{q.choice('warehouse_location', specs.COUNTRIES)} AS warehouse_location",
        f"CAST({q.below('quantity_on_hand', 0, 1000)} AS {n}) AS quantity_on_hand",
        f"CAST({q.below('quantity_allocated', 0, 100)} AS {n}) AS quantity_allocated",
        f"CAST({q.below('reorder_point', 10, 100)} AS {n}) AS reorder_point",
        f"CAST({q.below('reorder_quantity', 50, 500)} AS {n}) AS reorder_quantity",
        f"{q.exp_money('unit_cost', 20)} AS unit_cost", f"{q.ts('inventory', HOUR)} AS last_updated",
    ]
    if q.lake:
        cols += [f"{q.date('inventory', HOUR)} AS last_updated_date", *q.audit(updated=False)]
    return cols


def _events(q: Q) -> list[str]:
    ip = "concat_ws('.', " + ", ".join(q.s(q.between(f"ip.{k}", 1, 255)) for k in range(4)) + ")"
    session = (q.txt("'session_'", f"substr({q.key('session_id')}, 1, 8)") if q.lake
               else q.txt("'session_'", q.s(q.between("session_id", 1, 1000000))))
    cols = [
        "id AS event_id", f"{q.fk('customer_id', 'customers')} AS customer_id",
        f"{q.choice('event_type', specs.EVENT_TYPES)} AS event_type", f"{q.ts('events', 1)} AS event_timestamp",
    ]
    if q.lake:
        cols.append(f"{q.date('events', 1)} AS event_date")
    search = q.txt("'search term '", q.s(q.between("search_term", 1, 10000)))
    cols += [
        q.txt("'/page/'", q.s(q.between("page_url", 1, 1000))) + " AS page_url",
        q.txt("'Mozilla/5.0 Browser '", q.s(q.between("user_agent", 1, 100))) + " AS user_agent",
        f"{ip} AS ip_address", f"{q.choice('country', specs.COUNTRIES)} AS country",
        f"{q.choice('device_type', specs.DEVICE_TYPES)} AS device_type", f"{session} AS session_id",
        f"{q.nfk('product_id', 'products')} AS product_id",
        f"CASE WHEN {q.u('search_query')} > {_dbl(0.7)} THEN {search} END AS search_query",
        *q.audit(updated=False),
    ]
    return cols


RECIPES = {
    "customers": _customers, "products": _products, "suppliers": _suppliers, "orders": _orders,
    "lineitem": _lineitem, "inventory": _inventory, "events": _events,
}


def generator_sql(table: str, profile: str, seed: int = 42) -> str:
    cols = RECIPES[table](Q(table, profile, seed))
    return f"SELECT {', '.join(cols)}\nFROM range(1, {rows_sql(table)} + 1) t(id)"
