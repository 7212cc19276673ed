"""Landing, catalog and file queries over the given test tables.

Each query lands rows of the given tables through the library's own sinks,
below the session's shared folder, and reads them back through Spark, so a
sink that drops, repeats or misplaces rows shows in its result.  Declared
columns that the given tables do not have are null.  Catalog tables get a
namespace of their own per run, which is dropped once the result is there.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import specs
from ledgerline.functions.aggregates import long_sum, money_sum, revenue_sum
from ledgerline.operators import calendar, distinct, quality
from ledgerline.plans.sql_corpus import PUBLISHED_SQL
from ledgerline.session import scratch_path
from ledgerline.sinks import audit, layout, manifest, rerun
from ledgerline.sinks.land import land_tables
from ledgerline.sources import catalog
from ledgerline.sources.driver_tables import model, orders as mapped_orders, read_raw

SINCE = "2000-01-01"
#: Months with an order of at least so much.
LARGE_ORDER = 499_700
#: The year whose orders are landed again, each dearer by this much.
RERUN_YEAR, CORRECTION = 1998, "1.00"
#: Rows of a landed file at most, where file sizes are looked at.
FILE_ROWS = 5_000


def _namespace(spark: SparkSession) -> str:
    name = f"ledgerline_{uuid.uuid4().hex[:12]}"
    catalog.create_namespace(spark, name)
    return name


def _written(df: DataFrame, namespace: str | None = None) -> DataFrame:
    """A small result, written down, so that the namespace it was read from can go."""
    path = scratch_path(df.sparkSession, "result")
    df.write.parquet(path)
    if namespace:
        catalog.drop_namespace(df.sparkSession, namespace)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The columns of a model table that the given tables have and its spec declares."""
    df = model(spark, sf_dir, table)
    if table == "orders":  # their country is the customer's
        df = df.join(model(spark, sf_dir, "customers", ("customer_id", "country")), "customer_id", "left")
    if table == "events":
        df = df.withColumn("event_date", F.to_date("event_timestamp"))
    declared = specs.spec(table).schema().fieldNames()
    return df.select(*[c for c in declared if c in df.columns])


def _absent(df: DataFrame, table: str) -> tuple[str, ...]:
    return tuple(c for c in specs.spec(table).schema().fieldNames() if c not in df.columns)


def _land(spark: SparkSession, sf_dir: str, table: str, granularity: str, **kw) -> str:
    """Given rows landed by their table's spec, date folders coarsened as asked for; returns the folder."""
    df, path = given(spark, sf_dir, table), scratch_path(spark, f"landed-{table}")
    layout.write_table(df, path, table, granularity=granularity, fill=_absent(df, table), **kw)
    return path


def orders_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed orders, in folders by customer country and order year, read back (every row)."""
    # the published spec is country x day; the test orders span 2,400 days, so the coarser year is asked for here
    return spark.read.parquet(_land(spark, sf_dir, "orders", "year"))


def orders_partitioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders since a date from the landed folders; the bound prunes folders."""
    since = layout.date_at_least(orders_partitioned(spark, sf_dir), "order_date", SINCE)
    return since.select("order_id", "customer_id", "order_date", "order_status", "total_amount", "country")


def lineitem_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_land(spark, sf_dir, "lineitem", "month"))


def lineitem_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per ship date since a date, from month folders (amounts in cents, as the spec lands them)."""
    since = layout.date_at_least(lineitem_landed(spark, sf_dir), "ship_date", SINCE)
    return since.groupBy("ship_date").agg(money_sum("net_amount").alias("revenue"), long_sum("quantity").alias("units"), F.count(F.lit(1)).alias("line_count"))


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed events, in the published folders: one per day and event type."""
    return spark.read.parquet(_land(spark, sf_dir, "events", "day"))


def events_daily_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases per day of a week, read from their seven folders."""
    e = events_daily(spark, sf_dir).where("event_type = 'purchase' AND event_date BETWEEN DATE'2024-01-10' AND DATE'2024-01-16'")
    return e.groupBy("event_date").agg(F.count(F.lit(1)).alias("purchases"), F.min("event_timestamp").alias("first_at"), F.max("event_id").alias("last_id"))


def revenue_of_large_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: revenue per ship month, for months in which a large order was placed.

    The months come from the orders at run time, so no literal can prune;
    Spark prunes the landed month folders by the join's own keys (dynamic
    partition pruning): only folders of those months are read.
    """
    large = mapped_orders(spark, sf_dir).where(F.col("total_amount") >= LARGE_ORDER)
    months = large.select(F.trunc("order_date", "month").alias("order_month")).distinct()
    li = lineitem_landed(spark, sf_dir).select("ship_date_month", "net_amount")
    return (li.join(months, F.col("ship_date_month") == F.col("order_month"))
            .groupBy("ship_date_month").agg(money_sum("net_amount").alias("revenue"), F.count(F.lit(1)).alias("line_count")))


def orders_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed, then one year landed again with corrected amounts: per folder its rows, its amount, and if its
    files are new (``rewritten``) or the very same as before (``untouched``)."""
    df, path = given(spark, sf_dir, "orders"), scratch_path(spark, "rerun")
    fill = _absent(df, "orders")
    layout.write_table(df, path, "orders", granularity="year", fill=fill)
    corrected = df.where(F.year("order_date") == RERUN_YEAR).withColumn("total_amount", F.col("total_amount") + F.lit(CORRECTION).cast("decimal(12,2)"))
    _, kept = rerun.rerun(corrected, path, "orders", f"order_date_year = DATE'{RERUN_YEAR}-01-01'", granularity="year", fill=fill)
    kept = kept.select(
        F.regexp_extract("folder", r"^country=([^/]*)/", 1).alias("country"), F.regexp_extract("folder", r"order_date_year=(\d{4})", 1).cast("int").alias("order_year"),
        ((F.col("kept") == 0) & (F.col("files_after") > 0)).alias("rewritten"),
        ((F.col("kept") == F.col("files_before")) & (F.col("kept") == F.col("files_after"))).alias("untouched"))
    rows = spark.read.parquet(path).groupBy("country", F.year("order_date").alias("order_year")).agg(F.count(F.lit(1)).alias("orders"), money_sum("total_amount").alias("amount"))
    return rows.join(kept, ["country", "order_year"], "full")


REPORTED = ("customers", "products", "suppliers", "orders", "lineitem", "events")


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every given table landed by its spec; rows planned, counted by the writing job, and stated by the files' footers."""
    report = land_tables(spark, scratch_path(spark, "run"), {t: given(spark, sf_dir, t) for t in REPORTED}, granularity="year", fill=True)
    return report.select("table", "planned_rows", "written_rows", "actual_rows", "granularity", "ok", "error")


def landed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month folder of the landed line items the rows, those out of the declared order in their file, and the dates."""
    found = audit.spec_order(spark, _land(spark, sf_dir, "lineitem", "month"), "lineitem")
    month = F.to_date(F.regexp_extract("folder", r"ship_date_month=(.*)$", 1))
    return found.groupBy(month.alias("ship_month")).agg(
        long_sum("rows").alias("rows"), long_sum("out_of_order").alias("out_of_order"),
        F.min("first_key.ship_date").alias("first_date"), F.max("last_key.ship_date").alias("last_date"))


SCHEMA_TABLES = ("customer", "orders", "lineitem", "part", "supplier", "events")


def file_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of every file of the given tables, by the files' own footers, and if the table's files agree on them."""
    out = []
    for table in SCHEMA_TABLES:
        schemas = catalog.file_schemas(spark, f"{sf_dir}/{table}.parquet")
        drift = catalog.schema_drift(schemas).select("path", "column_name", "agrees")
        out.append(schemas.join(drift, ["path", "column_name"]).select(
            F.lit(table).alias("table_name"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "ordinal", "column_name", "data_type", "agrees"))
    return reduce(DataFrame.unionByName, out)


def customers_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers per month from stored daily sketches, beside the exact count.

    Two deliveries of orders, which share their days, are sketched apart and
    stored; the stored days are merged and rolled up without the orders."""
    o = mapped_orders(spark, sf_dir)
    path = scratch_path(spark, "customer-days")
    for delivery in (o.where("order_id % 2 = 0"), o.where("order_id % 2 <> 0")):
        distinct.distinct_state(delivery, ["order_date"], "customer_id").write.mode("append").parquet(path)
    days = distinct.merge(spark.read.parquet(path), keys=["order_date"])
    months = distinct.estimates(distinct.roll_up(days, [F.trunc("order_date", "month").alias("order_month")]))
    exact = o.groupBy(F.trunc("order_date", "month").alias("order_month")).agg(F.countDistinct("customer_id").alias("customers"))
    return months.join(exact, "order_month").select("order_month", F.col("rows").alias("orders"), "customers", distinct.within(F.col("distinct"), F.col("customers")).alias("estimate_within"))


def sales_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and amount per country and week, weeks without orders as zeros."""
    o = given(spark, sf_dir, "orders")
    sums = {"orders": F.count(F.lit(1)), "amount": money_sum("total_amount")}
    weeks = calendar.fill_periods(o, "order_date", "week", ["country"], sums, out="week_start")
    return weeks.withColumns({"week": calendar.period_label(F.col("week_start"), "week"), "week_end": F.date_add("week_start", 6)})


def events_created_or_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table is made by its spec, takes some rows, is loaded when asked for again, takes the rest.

    Per day and type (the spec's partitions): events, and if the catalog has the partition."""
    ns, path = _namespace(spark), scratch_path(spark, "events-table")
    e = given(spark, sf_dir, "events")
    name, made = catalog.create_or_load(spark, "events", ns, path)
    catalog.insert_table(e.where("event_id % 3 = 0"), name, "events", fill=_absent(e, "events"))
    same, again = catalog.create_or_load(spark, "events", ns, f"{path}-other")
    catalog.insert_table(e.where("event_id % 3 <> 0"), same, "events", fill=_absent(e, "events"))
    parts = spark.sql(f"SHOW PARTITIONS spark_catalog.{ns}.events").select(
        F.to_date(F.regexp_extract("partition", r"event_date=([^/]+)", 1)).alias("event_date"), F.regexp_extract("partition", r"event_type=([^/]+)", 1).alias("event_type"), F.lit(True).alias("listed"))
    rows = spark.table(f"spark_catalog.{ns}.events").groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("events"))
    out = rows.join(parts, ["event_date", "event_type"], "full").select("event_date", "event_type", "events", "listed", F.lit(made).alias("made_first"), F.lit(again).alias("made_again"))
    return _written(out, ns)


def landed_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of landed files, written as JSON and read back: rows per table, files, and if every
    entry (size, rows, ISO time) is that of the file in the listing."""
    root, names = scratch_path(spark, "manifest"), ["customers", "orders", "events"]
    land_tables(spark, root, {t: given(spark, sf_dir, t) for t in names}, granularity="year", fill=True)
    manifest.write(spark, root, names)
    read = manifest.read(spark, root)
    entries = manifest.files(read)
    now = reduce(DataFrame.unionByName, [audit.files(spark, f"{root}/{t}").select(F.lit(t).alias("table"), manifest.file_key(t).alias("key"), F.date_trunc("millisecond", "modified").alias("listed")) for t in names])
    wrong = manifest.changed(spark, root, read).groupBy("table").agg(F.count(F.lit(1)).alias("wrong"))
    per = entries.join(now, ["table", "key"], "full").groupBy("table").agg(
        long_sum("rows").alias("rows"), F.min(F.col("modified").eqNullSafe(F.col("listed"))).alias("times_agree"), (F.count(F.lit(1)) == F.countDistinct("key")).alias("keys_unique"))
    return per.join(wrong, "table", "left").select(F.col("table").alias("table_name"), "rows", "times_agree", "keys_unique", F.col("wrong").isNull().alias("unchanged"))


def landed_file_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by ship year in files of at most FILE_ROWS rows: per folder its rows, and if no file is above that
    (``bounded``) and the files are not more than twice as many as that takes (``filled``)."""
    path = _land(spark, sf_dir, "lineitem", "year", max_records_per_file=FILE_ROWS, target_file_bytes=64 << 20)
    found = audit.file_sizes(spark, path, target_bytes=64 << 20)
    year = F.regexp_extract("folder", r"ship_date_year=(\d{4})", 1).cast("int")
    need = F.ceil(F.col("rows") / FILE_ROWS)
    return found.select(year.alias("ship_year"), "rows", (F.col("most_rows") <= FILE_ROWS).alias("bounded"), (F.col("files") <= 2 * need).alias("filled"), (F.col("above_target") == 0).alias("below_target"))


ORDERS_FILE = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
])


def external_orders_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table with a declared schema over the given file, by its three-part name."""
    ns = _namespace(spark)
    catalog.create_external_table(spark, f"{ns}.orders_file", f"{sf_dir}/orders.parquet", ORDERS_FILE)
    return _written(spark.sql(f"""SELECT o_orderstatus AS order_status, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS amount
                                  FROM spark_catalog.{ns}.orders_file GROUP BY o_orderstatus"""), ns)


def inserted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made by its spec (folders by country and year) takes the orders in two inserts."""
    ns, path = _namespace(spark), scratch_path(spark, "inserted")
    o = given(spark, sf_dir, "orders")
    name = catalog.create_table(spark, "orders", ns, path, granularity="year")
    for part in (o.where(F.year("order_date") < 1999), o.where(F.year("order_date") >= 1999)):
        catalog.insert_table(part, name, "orders", granularity="year", fill=_absent(o, "orders"))
    return _written(spark.table(name).groupBy(F.year("order_date_year").alias("order_year")).agg(
        F.count(F.lit(1)).alias("orders"), money_sum("total_amount").alias("amount"), F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date")), ns)


def orders_with_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: older orders land first, ALTER TABLE adds a column, newer orders land with it; the older ones show null."""
    ns, path = _namespace(spark), scratch_path(spark, "evolved")
    o = mapped_orders(spark, sf_dir, with_priority=True)
    older, newer = o.where(F.col("order_date") < F.to_date(F.lit(SINCE))), o.where(F.col("order_date") >= F.to_date(F.lit(SINCE)))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in o.drop("order_priority").schema.fields)
    spark.sql(f"CREATE TABLE spark_catalog.{ns}.orders ({columns}) USING parquet LOCATION '{path}'")
    catalog.insert(older.drop("order_priority"), f"{ns}.orders")
    catalog.add_columns(spark, f"spark_catalog.{ns}.orders", "order_priority string")
    catalog.insert(newer, f"{ns}.orders")
    return _written(spark.table(f"spark_catalog.{ns}.orders"), ns)


def bucketed_revenue(spark: SparkSession, sf_dir: str, ns: str, buckets: int = 8) -> DataFrame:
    for name, df in (("orders", model(spark, sf_dir, "orders")), ("lineitem", model(spark, sf_dir, "lineitem"))):
        layout.write_bucketed(df, f"{ns}.{name}", "order_id", buckets, scratch_path(spark, f"bucketed-{name}"))
    li = spark.table(f"{ns}.lineitem").select("order_id", "net_micros")
    joined = li.join(spark.table(f"{ns}.orders").select("order_id", "order_status").hint("merge"), "order_id")
    return joined.groupBy("order_status").agg(revenue_sum("net_micros").alias("revenue"), F.count(F.lit(1)).alias("line_count"))


def bucketed_revenue_by_status(spark: SparkSession, sf_dir: str, buckets: int = 8) -> DataFrame:
    """Orders and line items bucketed on the order join without an exchange; revenue per order status."""
    ns = _namespace(spark)
    return _written(bucketed_revenue(spark, sf_dir, ns, buckets), ns)


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File name, column count and rows of each given table's files."""
    out = None
    for name in ("customer", "orders", "lineitem", "events"):
        df = catalog.scan(spark, f"{sf_dir}/{name}.parquet")
        file = F.regexp_extract("path", r"([^/]+)$", 1)
        part = catalog.rows_per_file(df).select(F.lit(name).alias("table_name"), file.alias("file_name"), F.lit(len(df.columns)).alias("columns"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def columns_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders columns with their filled rows and distinct values.

    A scan of one column each: no row is copied per column, and every
    column's distinct values are counted with partial sums."""
    raw = read_raw(spark, sf_dir, "orders")
    each = [raw.agg(F.lit(c).alias("column_name"), F.count(c).alias("filled"), F.countDistinct(c).alias("values")) for c in catalog.column_names(raw)]
    return reduce(DataFrame.unionByName, each)


def planned_vs_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the given tables against rows in the files landed from them by their specs."""
    names = ("customers", "products", "orders", "lineitem")
    tables = {t: given(spark, sf_dir, t) for t in names}
    planned = {t: df.count() for t, df in tables.items()}
    report = land_tables(spark, scratch_path(spark, "planned"), tables, planned, granularity="year", fill=True)
    return quality.completeness(spark, planned, report.select(F.col("table").alias("table_name"), F.col("actual_rows").alias("row_count")))


def _published(name: str, columns: list[str], order: list[str] | None = None):
    text = PUBLISHED_SQL[name]
    named = dict.fromkeys(t for t in re.findall(r"(?:FROM|JOIN)\s+(\w+)", text))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        mine = {v.name: spark.table(v.name) for v in spark.catalog.listTables() if v.isTemporary and v.name in named}
        for table in named:  # only the tables that the text names, as views: nothing is copied
            model(spark, sf_dir, table).createOrReplaceTempView(table)
        try:  # names are resolved here, before the views go again
            found = spark.sql(text).toDF(*columns)
        finally:
            for table in named:
                spark.catalog.dropTempView(table)
            for table, view in mine.items():
                view.createOrReplaceTempView(table)
        return found.orderBy(*order) if order else found

    run.__doc__ = f"The published text {name!r} as it stands, over views of the given rows."
    return run


LAKE_QUERIES = {
    "orders_partitioned_read": orders_partitioned_read,
    "lineitem_pruned_read": lineitem_pruned_read,
    "events_daily_read": events_daily_read,
    "revenue_of_large_months": revenue_of_large_months,
    "orders_rerun": orders_rerun,
    "run_report": run_report,
    "landed_order": landed_order,
    "file_schemas": file_schemas,
    "customers_per_month": customers_per_month,
    "sales_calendar": sales_calendar,
    "events_created_or_loaded": events_created_or_loaded,
    "landed_manifest": landed_manifest,
    "landed_file_sizes": landed_file_sizes,
    "external_orders_by_status": external_orders_by_status,
    "inserted_orders": inserted_orders,
    "orders_with_added_column": orders_with_added_column,
    "bucketed_revenue_by_status": bucketed_revenue_by_status,
    "file_inventory": file_inventory,
    "columns_of_orders": columns_of_orders,
    "planned_vs_landed": planned_vs_landed,
    "published_top_products": _published("top_products", ["product_name", "category", "total_sold", "total_revenue", "unique_customers"],
                                        order=["total_revenue", "product_name", "category"]),
    "published_customers_by_country": _published("customers_by_country", ["country", "customer_count"]),
    "published_table_row_counts": _published("table_row_counts", ["table_name", "row_count"]),
    "published_orders_without_customer": _published("orders_without_customer", ["orphan_count"]),
}
