"""What landed files look like: order inside them, sizes, and which of them a re-run replaced.

Everything is read from Spark's file metadata (``_metadata`` and the
``binaryFile`` listing); file contents are opened only for the columns a
check is about.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline import specs
from ledgerline.sources.catalog import list_files

#: Consecutive rows of a file that are put in order together, and rows that a task puts in order, about.
BLOCK_ROWS, TASK_ROWS = 32_768, 1_000_000


def folder_of(path: str | Column, root: str) -> Column:
    """The partition folders of a file below ``root`` (``country=US/order_date=2024-01-01``), empty at the top."""
    relative = F.regexp_replace(F.regexp_replace(F.col(path) if isinstance(path, str) else path, r"^file:/+", "/"), "^.*?" + _quoted(root) + "/+", "")
    return F.regexp_replace(relative, r"/?[^/]+$", "")


def metadata_path(address: str = "_metadata.file_path") -> Column:
    """The path of a row's file as a listing has it: ``_metadata`` writes it as an address, with escapes.

    Rows are grouped by the address as it stands, and ``address`` then names that column: unescaping costs
    microseconds, which are spent per file then, not per row."""
    return F.url_decode(F.replace(F.col(address), F.lit("+"), F.lit("%2B")))


def _quoted(root: str) -> str:
    bare = root.rstrip("/")
    return "\\Q" + (bare[5:] if bare.startswith("file:") else bare).lstrip("/") + "\\E"


def files(spark: SparkSession, path: str, address: bool = False) -> DataFrame:
    """``(folder, file, bytes, modified)`` of the data files below ``path``, from the listing alone; on request also the
    ``address`` that rows of the file have as ``_metadata.file_path``."""
    listed = list_files(spark, path)
    return listed.select(folder_of("path", path).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
                         F.col("length").alias("bytes"), F.col("modification_time").alias("modified"),
                         *([F.col("_metadata.file_path").alias("address")] if address else []))


def order_in_files(spark: SparkSession, path: str, sort_cols: list[str]) -> DataFrame:
    """Per file ``(folder, file, rows, out_of_order, first_key, last_key)``.

    ``out_of_order`` counts rows whose key is below that of the row before
    them in the file; 0 everywhere means the declared order holds.  A row's
    place is Parquet's own row index.  Only the sort columns are read.  A
    file is cut into blocks of BLOCK_ROWS consecutive rows, dealt out to so
    many tasks that each orders about TASK_ROWS rows however large the files
    are and however well their paths pack; the first row of a block is then
    compared with the last of the block before.
    """
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    tasks = max(spark.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    key = F.struct(*[F.col(c) for c in sort_cols])
    at = F.col("_metadata.row_index")
    rows = df.select(F.floor(at / BLOCK_ROWS).alias("block"), F.col("_metadata.file_path").alias("address"), at.alias("at"), key.alias("key"))
    in_block, in_file = Window.partitionBy("block", "address").orderBy("at"), Window.partitionBy("address").orderBy("block")
    rows = rows.repartition(tasks, "block", "address").withColumn("below", (F.col("key") < F.lag("key").over(in_block)).cast("bigint"))
    blocks = rows.groupBy("block", "address").agg(  # in the order of the window: no second sort
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("below"), F.lit(0)).alias("below"), F.min("key").alias("first_key"), F.max("key").alias("last_key"),
        F.min_by("key", "at").alias("start"), F.max_by("key", "at").alias("end"))
    blocks = blocks.withColumn("step", F.coalesce((F.col("start") < F.lag("end").over(in_file)).cast("bigint"), F.lit(0)))
    per = blocks.groupBy("address").agg(F.sum("rows").alias("rows"), F.sum(F.col("below") + F.col("step")).alias("out_of_order"),
                                        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"))
    per = per.withColumn("path", metadata_path("address"))
    return per.select(folder_of("path", path).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
                      "rows", "out_of_order", "first_key", "last_key")


def spec_order(spark: SparkSession, path: str, table: str) -> DataFrame:
    """W7 by the table's own spec, coarsened date folders included (they sort by the date first)."""
    ts = specs.spec(table)
    have = spark.read.option("pathGlobFilter", "*.parquet").parquet(path).columns
    coarse = [c for c in ts.partition_cols if f"{c}_month" in have or f"{c}_year" in have]
    return order_in_files(spark, path, [c for c in coarse if c not in ts.sort_cols] + list(ts.sort_cols))


def file_sizes(spark: SparkSession, path: str, target_bytes: int) -> DataFrame:
    """Per folder ``(folder, files, bytes, rows, largest, most_rows, above_target)`` against a target size.

    Sizes and rows come from ``_metadata`` and the footers; no column is read."""
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    per = df.groupBy(F.col("_metadata.file_path").alias("address"), F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    return per.groupBy(folder_of(metadata_path("address"), path).alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows"), F.max("size").alias("largest"),
        F.max("rows").alias("most_rows"),
        F.sum((F.col("size") > target_bytes).cast("bigint")).alias("above_target"))


def kept_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per folder ``(folder, files_before, files_after, kept)``: ``kept`` files are the same in both listings, by name,
    size and time of writing.  ``before`` has to be a written listing (see :func:`files`)."""
    key = ["folder", "file", "bytes", "modified"]
    both = before.withColumn("was", F.lit(1)).join(after.withColumn("is", F.lit(1)), key, "full")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    was, now = F.col("was").isNotNull(), F.col("is").isNotNull()
    return both.groupBy("folder").agg(count(was).alias("files_before"), count(now).alias("files_after"), count(was & now).alias("kept"))
