"""Scans, inspection and catalog helpers."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from conftest import SF_SMALL
from ledgerline import specs
from ledgerline.operators.generate import generate
from ledgerline.sources import catalog


def test_scan_pattern_and_schema(spark, tmp_root):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    df.write.parquet(os.path.join(tmp_root, "t"))
    with open(os.path.join(tmp_root, "t", "notes.txt"), "w") as f:
        f.write("not parquet")
    assert catalog.scan(spark, os.path.join(tmp_root, "t")).count() == 10
    typed = catalog.scan(spark, os.path.join(tmp_root, "t"), T.StructType.fromDDL("id bigint"))
    assert typed.columns == ["id"]


def test_inspect_sample_and_ddl(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    sch = catalog.inspect_schema(li).collect()
    assert [r.column_name for r in sch] == li.columns
    assert sch[0].ordinal == 1 and sch[0].data_type == "bigint"
    s = catalog.sample(li, 5).collect()
    assert len(s) == 5 and s == sorted(s, key=lambda r: tuple(r))
    assert catalog.column_names(li)[0] == "l_orderkey"
    ddl = catalog.ddl(li)
    assert ddl.startswith("l_orderkey BIGINT") and T.StructType.fromDDL(ddl) == li.schema


def test_list_files_and_rows_per_file(spark, tmp_root):
    spark.range(100).repartition(3).write.parquet(os.path.join(tmp_root, "p"))
    files = catalog.list_files(spark, os.path.join(tmp_root, "p")).collect()
    assert len(files) == 3 and all(f.length > 0 for f in files)
    per = catalog.rows_per_file(spark.read.parquet(os.path.join(tmp_root, "p"))).collect()
    assert sum(r.rows for r in per) == 100
    os.makedirs(os.path.join(tmp_root, "empty"))
    with open(os.path.join(tmp_root, "empty", "x.csv"), "w") as f:
        f.write("a")
    with pytest.raises(FileNotFoundError):
        catalog.list_files(spark, os.path.join(tmp_root, "empty"))


def test_catalog_conf():
    hive = catalog.catalog_conf("hive", "lake", "s3a://b/p/", uri="thrift://h:9083")
    assert hive["spark.sql.catalog.lake.type"] == "hive" and "spark.sql.catalog.lake.credential" not in hive
    rest = catalog.catalog_conf("rest", "uc", "s3a://b/p/", uri="https://x", credential="t")
    assert rest["spark.sql.catalog.uc.credential"] == "t"
    assert catalog.catalog_conf("session", "x", "/w") == {"spark.sql.warehouse.dir": "/w"}
    with pytest.raises(ValueError):
        catalog.catalog_conf("glue", "x", "/w")


def test_namespace_table_and_three_part_names(spark, tmp_root):
    catalog.create_namespace(spark, "bench")
    catalog.create_namespace(spark, "bench")  # idempotent
    name = catalog.create_table(spark, "orders", "bench", os.path.join(tmp_root, "orders"))
    assert name == "spark_catalog.bench.orders"
    assert catalog.create_table(spark, "orders", "bench", os.path.join(tmp_root, "other")) == name  # S7: reuse
    sizes = {"customers": 50, "orders": 200}
    df = generate(spark, "orders", 200, sizes)
    catalog.insert(df, name)
    assert spark.sql(f"SELECT COUNT(*) AS n FROM {name}").first().n == 200
    parts = spark.sql(f"SHOW PARTITIONS {name}").count()
    assert parts > 14
    catalog.add_columns(spark, name, "coupon string")  # T4: old files read as null
    spark.catalog.refreshTable(name)
    assert spark.sql(f"SELECT COUNT(*) AS n FROM {name} WHERE coupon IS NULL").first().n == 200
    spark.sql(f"DROP TABLE {name}")


def test_external_table(spark, tmp_root):
    path = os.path.join(tmp_root, "cust")
    generate(spark, "customers", 40, {}, profile="base").write.parquet(path)
    catalog.create_external_table(spark, "customers_ext", path, specs.spec("customers").schema("base"))
    try:
        assert spark.table("customers_ext").count() == 40
    finally:
        spark.sql("DROP TABLE customers_ext")


def test_arrow_type_mapping():
    assert catalog.spark_type(pa.int64()) == T.LongType()
    assert catalog.spark_type(pa.decimal128(12, 2)) == T.DecimalType(12, 2)
    assert catalog.spark_type(pa.timestamp("us")) == T.TimestampNTZType()
    assert catalog.spark_type(pa.date32()) == T.DateType()
    with pytest.raises(TypeError):
        catalog.spark_type(pa.list_(pa.int32()))


def test_peek_reads_one_file(spark, tmp_root):
    path = os.path.join(tmp_root, "many")
    spark.range(1000).selectExpr("id", "id % 7 AS g").repartition(5).write.parquet(path)
    got = catalog.peek(spark, path, 3)
    assert len(got.inputFiles()) == 1 and got.count() == 3
    rows = got.collect()
    assert rows == sorted(rows, key=lambda r: (r.id, r.g))
    with pytest.raises(FileNotFoundError):
        catalog.peek(spark, path, 3, suffix=".csv")


def test_register_lake_on_any_path(spark, tmp_root):
    spark.range(30).selectExpr("id AS customer_id", "'x' AS country").write.parquet(os.path.join(tmp_root, "lake", "customers"))
    for root in (os.path.join(tmp_root, "lake"), f"file://{tmp_root}/lake", f"file:{tmp_root}/lake/"):
        assert catalog.register_lake(spark, root, "anyfs") == ["spark_catalog.anyfs.customers"]
        assert spark.sql("SELECT count(*) AS n FROM spark_catalog.anyfs.customers").first().n == 30
    with pytest.raises(FileNotFoundError):
        catalog.register_lake(spark, root, "anyfs", tables=["orders"])
    with pytest.raises(FileNotFoundError):
        catalog.register_lake(spark, os.path.join(tmp_root, "absent"), "anyfs")
    spark.sql("DROP TABLE spark_catalog.anyfs.customers")


def test_insert_refuses_missing_and_extra_columns(spark, tmp_root):
    spark.sql(f"CREATE TABLE ins (a int, b string) USING parquet LOCATION '{tmp_root}/ins'")
    try:
        for ddl, row in (("a int", (1,)), ("a int, b string, c int", (1, "x", 2))):
            with pytest.raises(ValueError):
                catalog.insert(spark.createDataFrame([row], ddl), "ins")
        catalog.insert(spark.createDataFrame([("x", 1)], "b string, a int"), "ins")
        assert tuple(spark.table("ins").first()) == (1, "x")
    finally:
        spark.sql("DROP TABLE ins")
