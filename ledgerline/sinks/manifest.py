"""A manifest of landed files, made by Spark from the files themselves and kept as one JSON text a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sinks import audit

#: ISO 8601 with milliseconds, in UTC.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"

FILE = T.StructType([
    T.StructField("rows", T.LongType()), T.StructField("bytes", T.LongType()), T.StructField("modified", T.StringType()),
])
#: One table's manifest: its files by key, see :func:`file_key`.
TABLE = T.StructType([
    T.StructField("table", T.StringType()), T.StructField("generated_at", T.StringType()), T.StructField("format", T.StringType()),
    T.StructField("compression", T.StringType()), T.StructField("files", T.MapType(T.StringType(), FILE)),
])


def file_key(table: str, folder: str = "folder", file: str = "file") -> F.Column:
    """``orders/country=US/00003-5f2c9d1e``: folder, zero-padded part number and eight digits of a digest of the file's name."""
    number = F.lpad(F.regexp_extract(file, r"part-0*(\d+)", 1), 5, "0")
    return F.concat_ws("/", F.lit(table), F.nullif(F.col(folder), F.lit("")), F.concat_ws("-", number, F.substring(F.md5(F.col(file)), 1, 8)))


def describe(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``(key, rows, bytes, modified)`` of the files below ``root/<table>``: rows by their footers, the rest by the listing.

    Both sides have a file's address as Spark writes it, so rows are counted by that alone: folder and file taken from it on
    the counted side would be join keys, whose null checks Spark puts below the count, at several regular expressions a row."""
    path = f"{root.rstrip('/')}/{table}"
    counted = spark.read.option("pathGlobFilter", "*.parquet").parquet(path).groupBy(F.col("_metadata.file_path").alias("address")).agg(F.count(F.lit(1)).alias("rows"))
    both = audit.files(spark, path, address=True).join(counted, "address", "left")
    return both.select(file_key(table).alias("key"), F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), "bytes", F.date_format("modified", ISO_FORMAT).alias("modified"))


def write(spark: SparkSession, root: str, tables: list[str]) -> str:
    """Writes ``root/_files``, a line of JSON per table with a map of its files; the leading underscore hides it from table readers.

    The number of files bounds a line: they are what a listing holds as well."""
    out = None
    for t in tables:
        entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", F.struct("rows", "bytes", "modified").alias("value")))))
        row = describe(spark, root, t).agg(entries.alias("files")).select(
            F.lit(t).alias("table"), F.date_format(F.current_timestamp(), ISO_FORMAT).alias("generated_at"),
            F.lit("parquet").alias("format"), F.lit("snappy").alias("compression"), "files")
        out = row if out is None else out.unionByName(row)
    path = f"{root.rstrip('/')}/_files"
    out.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
    return path


def read(spark: SparkSession, root: str) -> DataFrame:
    """The manifest by its declared schema; a line that is not such JSON is an error, not a row of nulls."""
    lines = spark.read.text(f"{root.rstrip('/')}/_files")
    return lines.select(F.from_json("value", TABLE, {"mode": "FAILFAST"}).alias("m")).select("m.*")


def files(manifest: DataFrame) -> DataFrame:
    """``(table, key, rows, bytes, modified)``, times as timestamps again."""
    each = manifest.select("table", F.explode("files").alias("key", "file"))
    return each.select("table", "key", "file.rows", "file.bytes", F.to_timestamp("file.modified", ISO_FORMAT).alias("modified"))


def changed(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """``(table, key, was, now)``: files that came, went or have another size or number of rows than the manifest says."""
    stated = files(manifest).select("table", "key", F.struct("rows", "bytes").alias("was"))
    now = None
    for t in [r.table for r in manifest.select("table").collect()]:
        part = describe(spark, root, t).select(F.lit(t).alias("table"), "key", F.struct("rows", "bytes").alias("now"))
        now = part if now is None else now.unionByName(part)
    return stated.join(now, ["table", "key"], "full").where(~F.col("was").eqNullSafe(F.col("now")))
