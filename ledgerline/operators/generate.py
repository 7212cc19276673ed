"""Table generators G1-G7 and row planning R1-R5.

Each table is ``spark.range(1, rows + 1)`` followed by one projection of
column expressions, so generation is a single map-only stage: no shuffle,
no Python worker, no driver-side key lists.  Foreign keys are drawn from
the parent's planned row count, so every key resolves (no orphans), and
every value is a function of (seed, table, column, row id), so the output
is the same for any partitioning or retry.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import specs
from ledgerline.functions.draws import (
    Draws,
    even_date,
    half_up_units,
    money,
    round_half_up,
    span_steps,
    step_date,
    step_timestamp,
    text,
    units_to_decimal,
)
from ledgerline.specs import (
    BRAND_WORDS,
    CATEGORIES,
    COUNTRIES,
    DEVICE_TYPES,
    EVENT_TYPES,
    LINE_STATUSES,
    ORDER_STATUSES,
    PAYMENT_METHODS,
    PRODUCT_WORDS,
    REGIONS,
    STREET_WORDS,
    SUPPLIER_WORDS,
)

DEFAULT_SEED = 42
DEFAULT_AUDIT_TS = "2024-01-01 00:00:00"

HOUR, MINUTE, DAY = 3600, 60, 86400

# Time windows of the step series (start, end); long tables wrap inside them.
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


class _Ctx:
    """What a recipe needs: row id, 0-based index, sizes, draws, audit time."""

    def __init__(self, table: str, profile: str, rows: int, parents: dict[str, int],
                 seed: int, hash: str, audit_ts: str):
        self.table, self.profile, self.rows = table, profile, rows
        self.parents = parents
        self.id = F.col("id")
        self.i = F.col("id") - F.lit(1)
        self.d = Draws(self.id, seed, table, hash)
        self.audit = F.lit(audit_ts).cast("timestamp_ntz")
        self.lake = profile == "lake"

    def parent(self, table: str) -> int:
        try:
            return self.parents[table]
        except KeyError:
            raise ValueError(f"{self.table} needs the row count of parent table {table!r}") from None

    def steps(self, window: str, step: int) -> tuple[str, int]:
        start, end = WINDOWS[window]
        return start, span_steps(start, end, step)

    def series_ts(self, window: str, step: int) -> Column:
        start, n = self.steps(window, step)
        return step_timestamp(self.i, start, step, n)

    def series_date(self, window: str, step: int) -> Column:
        start, n = self.steps(window, step)
        return step_date(self.i, start, step, n)


# -- shared column recipes ------------------------------------------------------
# Survey primitives: P1 row id (spark.range), P2 choice, P3 bernoulli, P4 normal,
# P5 exponential, P6 uniform, P7/P8 half-open/closed ints, P9 step series, P10
# evenly spaced dates, P11 timestamp->date, P12 year, P13 date + days, P14/P15
# (nullable) foreign keys, P16 sparse text, P17-P19 templated strings, P20
# session ids, P21 derived money, P22 audit time (a parameter, not "now"); an
# unknown table or profile raises.

def _person_name(c: _Ctx, name: str) -> Column:
    if c.lake:
        return text("Customer_", c.d.int_between(name, 10000, 99999))
    return text("Name_", c.d.int_between(name, 1000, 9999))


def _email(c: _Ctx, name: str) -> Column:
    if c.lake:
        return text("user", c.d.int_between(name, 10000, 99999), "@example.com")
    return text("user", c.id, "@example.com")


def _phone(c: _Ctx, name: str) -> Column:
    return text("+1-", c.d.int_between(name + ".a", 200, 999), "-", c.d.int_between(name + ".b", 100, 999),
                "-", c.d.int_between(name + ".c", 1000, 9999))


def _address(c: _Ctx, name: str) -> Column:
    street = c.d.choice(name + ".street", STREET_WORDS) if c.lake else F.lit("Main")
    return text(c.d.int_between(name + ".no", 1, 9999), " ", street, " St, City ",
                c.d.int_between(name + ".city", 1, 1000))


def _exp_money(c: _Ctx, name: str, mean: float, precision: int = 10) -> Column:
    v = c.d.exponential(name, mean)
    return money(v, precision) if c.lake else round_half_up(v, 2)


def _micro(c: Column) -> Column:
    """Unrounded base-profile money, kept to 6 decimals.

    ``ln`` may differ in the last bit between the JVM (StrictMath) and a C
    libm, so a full-precision double is not reproducible across engines;
    micro-units are.
    """
    return round_half_up(c, 6)


def _audit(c: _Ctx, updated: bool = True) -> list[Column]:
    if not c.lake:
        return []
    cols = [c.audit.alias("created_at")]
    if updated:
        cols.append(c.audit.alias("updated_at"))
    return cols


# -- table recipes ---------------------------------------------------------------

def _customers(c: _Ctx) -> list[Column]:
    d = c.d
    reg = c.series_date("customers.registration", HOUR) if c.lake else c.series_ts("customers.registration", HOUR)
    login = c.series_ts("customers.last_login." + c.profile, HOUR)
    score = d.normal("credit_score", 650, 100).cast("int" if c.lake else "bigint")
    return [
        c.id.alias("customer_id"),
        _person_name(c, "customer_name").alias("customer_name"),
        _email(c, "email").alias("email"),
        _phone(c, "phone").alias("phone"),
        _address(c, "address").alias("address"),
        d.choice("country", COUNTRIES).alias("country"),
        d.choice("region", REGIONS).alias("region"),
        reg.alias("registration_date"),
        score.alias("credit_score"),
        round_half_up(d.exponential("lifetime_value", 500), 2).alias("lifetime_value"),
        d.bernoulli("is_premium", 0.2).alias("is_premium"),
        login.alias("last_login"),
        *_audit(c),
    ]


def _products(c: _Ctx) -> list[Column]:
    d = c.d
    if c.lake:
        name = text("Product_", d.choice("product_name.word", PRODUCT_WORDS), d.int_between("product_name", 1, 100000))
        brand = text("Brand_", d.choice("brand.word", BRAND_WORDS), d.int_between("brand", 1, 1000))
        cost = money(d.exponential("cost", 50) * d.uniform("cost.share", 0.3, 0.8))
        weight = round_half_up(d.exponential("weight", 2), 2).cast("float")
        desc = text("Product description for item ", d.int_between("description", 10000, 99999))
        created = c.series_date("products.created", HOUR)
    else:
        name = text("Product_", c.id)
        brand = text("Brand_", d.int_between("brand", 1, 1000))
        cost = _micro(d.exponential("cost", 50) * d.uniform("cost.share", 0.3, 0.8))
        weight = round_half_up(d.exponential("weight", 2), 2)
        desc = text("Description for item ", c.id)
        created = c.series_ts("products.created", HOUR)
    dims = text(d.int_between("dim.x", 1, 50), "x", d.int_between("dim.y", 1, 50), "x", d.int_between("dim.z", 1, 50))
    return [
        c.id.alias("product_id"),
        name.alias("product_name"),
        d.choice("category", CATEGORIES).alias("category"),
        brand.alias("brand"),
        _exp_money(c, "price", 50).alias("price"),
        cost.alias("cost"),
        weight.alias("weight"),
        dims.alias("dimensions"),
        desc.alias("description"),
        d.foreign_key("supplier_id", c.parent("suppliers")).alias("supplier_id"),
        created.alias("created_date"),
        d.bernoulli("is_active", 0.8).alias("is_active"),
        *_audit(c),
    ]


def _suppliers(c: _Ctx) -> list[Column]:
    d = c.d
    rating = round_half_up(d.uniform("rating", 1, 5), 1)
    if c.lake:
        name = text("Supplier_", d.choice("supplier_name.word", SUPPLIER_WORDS), d.int_between("supplier_name", 1, 10000))
        start, end = WINDOWS["suppliers.established"]
        est = even_date("id", c.rows, start, end)
        extra = [rating.cast("float").alias("rating"), est.alias("established_date"),
                 F.year(est).alias("established_year")]
    else:
        name = text("Supplier_", c.id)
        extra = [rating.alias("rating"), c.series_ts("suppliers.established", DAY).alias("established_date")]
    return [
        c.id.alias("supplier_id"),
        name.alias("supplier_name"),
        _person_name(c, "contact_name").alias("contact_name"),
        _email(c, "email").alias("email"),
        _phone(c, "phone").alias("phone"),
        _address(c, "address").alias("address"),
        d.choice("country", COUNTRIES).alias("country"),
        d.choice("region", REGIONS).alias("region"),
        *extra,
        d.bernoulli("is_verified", 0.7).alias("is_verified"),
        *_audit(c),
    ]


def _orders(c: _Ctx) -> list[Column]:
    d = c.d
    if c.lake:
        start, end = WINDOWS["orders"]
        od = even_date("id", c.rows, start, end)
        dates = [od.alias("order_date"),
                 F.date_add(od, d.int_between("ship_days", 1, 3).cast("int")).alias("ship_date"),
                 F.date_add(od, d.int_between("delivery_days", 3, 10).cast("int")).alias("delivery_date")]
        tax = money(d.exponential("tax_amount", 100) * F.lit(0.1))
    else:
        od = c.series_ts("orders", MINUTE)
        dates = [od.alias("order_date"),
                 F.timestamp_add("DAY", F.lit(1), od).alias("ship_date"),
                 F.timestamp_add("DAY", F.lit(4), od).alias("delivery_date")]
        tax = _micro(d.exponential("tax_amount", 100) * F.lit(0.1))
    return [
        c.id.alias("order_id"),
        d.foreign_key("customer_id", c.parent("customers")).alias("customer_id"),
        *dates,
        d.choice("order_status", ORDER_STATUSES).alias("order_status"),
        d.choice("payment_method", PAYMENT_METHODS).alias("payment_method"),
        _exp_money(c, "total_amount", 100, 12).alias("total_amount"),
        tax.alias("tax_amount"),
        _exp_money(c, "shipping_amount", 10, 8).alias("shipping_amount"),
        _exp_money(c, "discount_amount", 5, 8).alias("discount_amount"),
        d.choice("country", COUNTRIES).alias("country"),
        d.choice("region", REGIONS).alias("region"),
        *_audit(c),
    ]


def _lineitem(c: _Ctx) -> list[Column]:
    d = c.d
    qty = d.int_below("quantity", 1, 20)
    unit_cents = half_up_units(d.exponential("unit_price", 25), 2)
    unit = unit_cents / F.lit(100.0)
    discount = round_half_up(d.uniform("discount", 0, 0.3), 3)
    tax = round_half_up(d.uniform("tax", 0.05, 0.15), 3)
    if c.lake:
        gross = qty.cast("double") * unit
        money_cols = [
            units_to_decimal(unit_cents, 10).alias("unit_price"),
            discount.cast("float").alias("discount"),
            tax.cast("float").alias("tax"),
            units_to_decimal(qty * unit_cents, 12).alias("extended_price"),
            money(gross * d.uniform("discount_amount", 0, 0.3)).alias("discount_amount"),
            money(gross * d.uniform("tax_amount", 0.05, 0.15)).alias("tax_amount"),
            money(gross * d.uniform("net_amount", 0.8, 1.2), 12).alias("net_amount"),
        ]
        start, end = WINDOWS["lineitem"]
        ship = even_date("id", c.rows, start, end)
        comment = text("Comment ", d.int_between("comment", 100000, 999999))
    else:
        money_cols = [
            unit.alias("unit_price"),
            discount.alias("discount"),
            tax.alias("tax"),
            _micro(d.int_below("extended_price.qty", 1, 20).cast("double")
                   * d.exponential("extended_price", 25)).alias("extended_price"),
            _micro(d.exponential("discount_amount.base", 25)
                   * d.uniform("discount_amount", 0, 0.3)).alias("discount_amount"),
            _micro(d.exponential("tax_amount.base", 25) * d.uniform("tax_amount", 0.05, 0.15)).alias("tax_amount"),
            _micro(d.exponential("net_amount.base", 25) * d.uniform("net_amount", 0.8, 1.2)).alias("net_amount"),
        ]
        ship = c.series_ts("lineitem", MINUTE)
        comment = text("Comment ", d.int_between("comment", 1, 1000000))
    return [
        c.id.alias("lineitem_id"),
        d.foreign_key("order_id", c.parent("orders")).alias("order_id"),
        d.foreign_key("product_id", c.parent("products")).alias("product_id"),
        qty.cast("int" if c.lake else "bigint").alias("quantity"),
        *money_cols,
        d.choice("line_status", LINE_STATUSES).alias("line_status"),
        ship.alias("ship_date"),
        comment.alias("comment"),
        *_audit(c),
    ]


def _inventory(c: _Ctx) -> list[Column]:
    d = c.d
    n = "int" if c.lake else "bigint"
    updated = c.series_ts("inventory", HOUR)
    cols = [
        c.id.alias("inventory_id"),
        d.foreign_key("product_id", c.parent("products")).alias("product_id"),
        d.foreign_key("supplier_id", c.parent("suppliers")).alias("supplier_id"),
        d.choice("warehouse_location", COUNTRIES).alias("warehouse_location"),
        d.int_below("quantity_on_hand", 0, 1000).cast(n).alias("quantity_on_hand"),
        d.int_below("quantity_allocated", 0, 100).cast(n).alias("quantity_allocated"),
        d.int_below("reorder_point", 10, 100).cast(n).alias("reorder_point"),
        d.int_below("reorder_quantity", 50, 500).cast(n).alias("reorder_quantity"),
        _exp_money(c, "unit_cost", 20).alias("unit_cost"),
        updated.alias("last_updated"),
    ]
    if c.lake:
        cols += [c.series_date("inventory", HOUR).alias("last_updated_date"), *_audit(c, updated=False)]
    return cols


def _events(c: _Ctx) -> list[Column]:
    d = c.d
    ts = c.series_ts("events", 1)
    ip = F.concat_ws(".", *[d.int_between(f"ip.{k}", 1, 255).cast("string") for k in range(4)])
    session = (text("session_", d.hex8("session_id")) if c.lake
               else text("session_", d.int_between("session_id", 1, 1000000)))
    cols = [
        c.id.alias("event_id"),
        d.foreign_key("customer_id", c.parent("customers")).alias("customer_id"),
        d.choice("event_type", EVENT_TYPES).alias("event_type"),
        ts.alias("event_timestamp"),
    ]
    if c.lake:
        cols.append(c.series_date("events", 1).alias("event_date"))
    cols += [
        text("/page/", d.int_between("page_url", 1, 1000)).alias("page_url"),
        text("Mozilla/5.0 Browser ", d.int_between("user_agent", 1, 100)).alias("user_agent"),
        ip.alias("ip_address"),
        d.choice("country", COUNTRIES).alias("country"),
        d.choice("device_type", DEVICE_TYPES).alias("device_type"),
        session.alias("session_id"),
        d.nullable_foreign_key("product_id", c.parent("products")).alias("product_id"),
        d.sparse("search_query", 0.7, text("search term ", d.int_between("search_term", 1, 10000))).alias("search_query"),
        *_audit(c, updated=False),
    ]
    return cols


RECIPES = {
    "customers": _customers,
    "products": _products,
    "suppliers": _suppliers,
    "orders": _orders,
    "lineitem": _lineitem,
    "inventory": _inventory,
    "events": _events,
}


def generate(spark: SparkSession, table: str, rows: int, parents: dict[str, int] | None = None,
             profile: str = "lake", seed: int = DEFAULT_SEED, audit_ts: str = DEFAULT_AUDIT_TS,
             hash: str = "md5", rows_per_partition: int | None = None) -> DataFrame:
    """Generate ``rows`` rows of ``table`` as a DataFrame.

    ``parents`` maps each parent table to its row count; foreign keys are
    drawn from ``1..parent_rows``.  The result has exactly the declared
    schema of ``profile``.
    """
    specs.check_profile(profile)
    ts = specs.spec(table)
    n = max(1, rows)
    per_part = rows_per_partition or specs.CHUNK_ROWS[profile]
    # At least one partition per core once there are 10K rows per core; at
    # scale the chunk size sets the count (60B rows -> 120K tasks).
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, math.ceil(n / per_part), min(cores, n // 10_000))
    ctx = _Ctx(table, profile, n, dict(parents or {}), seed, hash, audit_ts)
    df = spark.range(1, n + 1, 1, parts).select(*RECIPES[table](ctx))
    schema = ts.schema(profile)
    if df.columns != schema.fieldNames():
        raise AssertionError(f"{table}/{profile}: columns {df.columns} != {schema.fieldNames()}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# -- row planning (R1-R5) ---------------------------------------------------------

def plan_rows(size_gb: float, tables: list[str] | None = None, profile: str = "lake") -> list[dict]:
    """Rows per table for a target volume: ratio * GB * rows-per-GB,
    and the number of generator partitions (chunks) at the profile's chunk size.

    Unknown table names raise before any work starts.
    """
    specs.check_profile(profile)
    names = list(tables) if tables else list(specs.TABLE_ORDER)
    for t in names:
        specs.spec(t)
    out = []
    for t in names:
        target = int(size_gb * specs.SIZE_RATIOS[t] * specs.ROWS_PER_GB)
        rows = max(1, target)
        out.append({"table": t, "target_rows": target, "rows": rows,
                    "partitions": max(1, math.ceil(rows / specs.CHUNK_ROWS[profile]))})
    return out


def plan_rows_df(spark: SparkSession, size_gb: float, tables: list[str] | None = None,
                 profile: str = "lake") -> DataFrame:
    """R2/R3 as a DataFrame: ``(table, target_rows, rows, partitions)``."""
    rows = [(p["table"], p["target_rows"], p["rows"], p["partitions"]) for p in plan_rows(size_gb, tables, profile)]
    return spark.createDataFrame(rows, "table string, target_rows bigint, rows bigint, partitions bigint")


def plan_sizes(size_gb: float) -> dict[str, int]:
    return {p["table"]: p["rows"] for p in plan_rows(size_gb)}


def generate_all(spark: SparkSession, sizes: dict[str, int], profile: str = "lake", **kw) -> dict[str, DataFrame]:
    """All tables for a size plan, keyed by table name (lazy DataFrames)."""
    return {t: generate(spark, t, sizes[t], sizes, profile=profile, **kw) for t in specs.TABLE_ORDER if t in sizes}
