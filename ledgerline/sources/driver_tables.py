"""Read the TPC-H-style test tables and expose them as the retail model.

The mapping is a projection plus two small dimension joins (nation,
region), so Catalyst prunes columns and pushes filters straight into the
Parquet scans.  Money is carried as decimal so sums are exact.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read straight from its Parquet file."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_raw(spark, sf_dir, "nation")
    region = read_raw(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select("n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("region")))


def net_amount(price: str = "l_extendedprice", discount: str = "l_discount", tax: str = "l_tax"):
    """price * (1 - discount) * (1 + tax), exact in decimal."""
    return (F.col(price).cast("decimal(12,2)")
            * (F.lit(1) - F.col(discount).cast("decimal(4,2)"))
            * (F.lit(1) + F.col(tax).cast("decimal(4,2)")))


def net_micros(price: str = "l_extendedprice", discount: str = "l_discount", tax: str = "l_tax"):
    """The same amount in millionths, as an exact integer:
    cents * (100 - discount %) * (100 + tax %).

    Long arithmetic instead of two ``BigDecimal`` multiplications per row;
    sums of it stay on Spark's fast long path (see ``revenue_sum``).
    """
    def hundredths(c: str):
        return F.round(F.col(c) * F.lit(100)).cast("bigint")

    return hundredths(price) * (F.lit(100) - hundredths(discount)) * (F.lit(100) + hundredths(tax))


GEOGRAPHY = {"country", "region"}


def customers(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """A customer without a nation keeps a null country.  Nation and region are
    joined only when one of their columns is asked for."""
    c = read_raw(spark, sf_dir, "customer")
    if columns is not None and not GEOGRAPHY & set(columns):
        c = c.select("*", F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("region"))
    else:
        c = c.join(_geo(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left")
    return (c.select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    "country", "region",
                    F.col("c_acctbal").alias("lifetime_value")))


def suppliers(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """As for customers."""
    s = read_raw(spark, sf_dir, "supplier")
    if columns is not None and not GEOGRAPHY & set(columns):
        s = s.select("*", F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("region"))
    else:
        s = s.join(_geo(spark, sf_dir), s.s_nationkey == F.col("n_nationkey"), "left")
    return (s.select(F.col("s_suppkey").alias("supplier_id"),
                    F.col("s_name").alias("supplier_name"),
                    "country", "region",
                    F.col("s_acctbal").alias("account_balance")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_raw(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"),
                    F.col("p_brand").alias("brand"),
                    F.col("p_retailprice").cast("decimal(10,2)").alias("price"))


def orders(spark: SparkSession, sf_dir: str, with_priority: bool = False) -> DataFrame:
    o = read_raw(spark, sf_dir, "orders")
    cols = [F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount")]
    if with_priority:  # a column the model does not have, used to show schema evolution
        cols.append(F.col("o_orderpriority").alias("order_priority"))
    return o.select(*cols)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_raw(spark, sf_dir, "lineitem")
    return li.select(F.col("l_linenumber").cast("bigint").alias("lineitem_id"),
                     F.col("l_orderkey").alias("order_id"),
                     F.col("l_partkey").alias("product_id"),
                     F.col("l_suppkey").alias("supplier_id"),
                     F.col("l_quantity").cast("bigint").alias("quantity"),
                     net_amount().alias("net_amount"),
                     net_micros().alias("net_micros"),
                     F.col("l_linestatus").alias("line_status"),
                     F.col("l_shipdate").cast("date").alias("ship_date"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_raw(spark, sf_dir, "events")
    return e.select("event_id",
                    F.col("user_id").alias("customer_id"),
                    "event_type",
                    F.col("ts").alias("event_timestamp"),
                    "value")


MODEL_VIEWS = {
    "customers": customers,
    "suppliers": suppliers,
    "products": products,
    "orders": orders,
    "lineitem": lineitem,
    "events": events,
}


def model(spark: SparkSession, sf_dir: str, table: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """A table of the model, or those ``columns`` of it."""
    if table not in MODEL_VIEWS:
        raise ValueError(f"no driver mapping for {table!r}; have {sorted(MODEL_VIEWS)}")
    if columns is None:
        return MODEL_VIEWS[table](spark, sf_dir)
    df = MODEL_VIEWS[table](spark, sf_dir, columns) if table in ("customers", "suppliers") else MODEL_VIEWS[table](spark, sf_dir)
    return df.select(*columns)


def register_model_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views under the model names, for SQL users."""
    for name, build in MODEL_VIEWS.items():
        build(spark, sf_dir).createOrReplaceTempView(name)
