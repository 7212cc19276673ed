"""Scans, inspection and catalog helpers.

Everything is a Spark reader/catalog call; inspection results are
DataFrames.  Catalog bindings are returned as configuration pairs for
``spark.sql.catalog.<name>.*``; nothing here opens a connection itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import specs


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None,
         pattern: str = "*.parquet") -> DataFrame:
    """Read every file matching ``pattern`` under ``path`` as one table."""
    r = spark.read.option("pathGlobFilter", pattern)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def inspect_schema(df: DataFrame) -> DataFrame:
    """S3: ``(ordinal, column_name, data_type, nullable)`` for each column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, nullable boolean")


def sample(df: DataFrame, n: int = 5, order_cols: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order_cols`` (all columns by default)."""
    return df.orderBy(*(order_cols or df.columns)).limit(n)


def peek(spark: SparkSession, path: str, n: int = 5, suffix: str = ".parquet") -> DataFrame:
    """The first ``n`` rows (by all columns) of the first data file.

    Like the published inspector, only one file is read (the first by path
    name), so a peek at a 100 TB table costs one file, not a full scan.
    Partition columns of a partitioned table are not in the files and are
    not shown.
    """
    first = spark.read.parquet(min(_listing(spark, path, suffix).inputFiles()))
    return first.orderBy(*first.columns).limit(n)


def column_names(df: DataFrame) -> list[str]:
    """Column names, for writing DDL by hand."""
    return list(df.columns)


def ddl(df_or_schema) -> str:
    """The schema as a DDL string (``name type, ...``)."""
    schema = df_or_schema.schema if isinstance(df_or_schema, DataFrame) else df_or_schema
    return schema.toDDL()


def list_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """``(path, length, modification_time)`` of data files under ``path``.

    Uses the ``binaryFile`` source with only metadata columns selected, so
    file contents are not read.  Raises when nothing matches, as the
    published inspector does.
    """
    return _listing(spark, path, suffix).select("path", "length", F.col("modificationTime").alias("modification_time"))


def _listing(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
             .option("recursiveFileLookup", "true").load(path))
    if not files.inputFiles():  # the reader's own listing: no job
        raise FileNotFoundError(f"no *{suffix} files under {path}")
    return files


def rows_per_file(df: DataFrame) -> DataFrame:
    """``(path, rows)`` per input file, counted on the executors."""
    return df.groupBy(F.input_file_name().alias("path")).agg(F.count(F.lit(1)).alias("rows"))


# -- catalogs ------------------------------------------------------------------------

CATALOG_KINDS = ("hive", "rest", "session")


def catalog_conf(kind: str, name: str, warehouse: str, uri: str | None = None,
                 credential: str | None = None, options: dict | None = None) -> dict[str, str]:
    """``spark.sql.catalog.*`` settings for a table catalog.

    ``hive`` is a metastore catalog (uri = thrift address), ``rest`` a REST
    catalog (uri + credential), ``session`` Spark's built-in catalog.  Unset
    options are dropped; an unknown kind raises.  The table-format
    connector jar has to be on the classpath for ``hive``/``rest``.
    """
    if kind not in CATALOG_KINDS:
        raise ValueError(f"unknown catalog kind {kind!r}; expected one of {CATALOG_KINDS}")
    if kind == "session":
        return {"spark.sql.warehouse.dir": warehouse}
    prefix = f"spark.sql.catalog.{name}"
    conf = {
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": kind,
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse,
        f"{prefix}.credential": credential if kind == "rest" else None,
    }
    for k, v in (options or {}).items():
        conf[f"{prefix}.{k}"] = v
    return {k: str(v) for k, v in conf.items() if v is not None}


def create_namespace(spark: SparkSession, namespace: str, catalog: str = "spark_catalog") -> None:
    """S10."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.{namespace}")


def create_table(spark: SparkSession, table: str, namespace: str, location: str, profile: str = "lake",
                 catalog: str = "spark_catalog", partitioned: bool = True, granularity: str = "day") -> str:
    """Create the table if absent (schema, partition spec, location),
    otherwise keep the existing one.  Returns the three-part name (S13)."""
    return create_or_load(spark, table, namespace, location, profile, catalog, partitioned, granularity)[0]


def create_or_load(spark: SparkSession, table: str, namespace: str, location: str, profile: str = "lake",
                   catalog: str = "spark_catalog", partitioned: bool = True, granularity: str = "day") -> tuple[str, bool]:
    """(three-part name, made now).

    A table that is there is loaded as it is, with its rows and its own
    location.  Its columns and partition columns have to be those of the
    spec (columns added since are fine); a table of another shape raises
    instead of taking rows that do not fit.  ``granularity`` coarsens date
    partitions as :func:`ledgerline.sinks.layout.partition_columns` does.
    """
    from ledgerline.sinks.layout import partition_columns

    schema = specs.spec(table).schema(profile)
    name = f"{catalog}.{namespace}.{table}"
    pcols, derived = partition_columns(table, granularity) if partitioned else ([], {})
    wanted = {f.name: f.dataType for f in schema.fields} | {c: T.DateType() for c in derived}
    if spark.catalog.tableExists(name):
        have = {f.name: f.dataType for f in spark.table(name).schema.fields}
        wrong = sorted(c for c, t in wanted.items() if have.get(c) != t)
        parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        if wrong or parts != pcols:
            raise ValueError(f"{name} is there with another shape: columns {wrong}, partitions {parts} instead of {pcols}")
        return name, False
    columns = T.StructType([T.StructField(c, t) for c, t in wanted.items()])
    parts = f" PARTITIONED BY ({', '.join(pcols)})" if pcols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns.toDDL()}) USING parquet{parts} LOCATION '{location}'")
    return name, True


def drop_namespace(spark: SparkSession, namespace: str, catalog: str = "spark_catalog") -> None:
    """Drops a namespace and its table entries; files of tables with a location of their own stay."""
    spark.sql(f"DROP NAMESPACE IF EXISTS {catalog}.{namespace} CASCADE")


def insert_table(df: DataFrame, name: str, table: str, granularity: str = "day", profile: str = "lake", fill: tuple[str, ...] = ()) -> None:
    """Append rows to a catalog table of the spec, conformed, rebalanced on its partition columns and sorted as the spec says."""
    from ledgerline.sinks import layout

    rows, _ = layout.clustered(layout.conform(df, specs.spec(table).schema(profile), fill=fill), table, granularity)
    insert(rows, name)


def insert(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """Append (or overwrite) rows into a catalog table, matching columns
    by name.  ``insertInto`` is positional and partitioned tables keep their
    partition columns last, so the frame is reordered first."""
    target = df.sparkSession.table(name).columns
    missing = [c for c in target if c not in df.columns]
    extra = [c for c in df.columns if c not in target]
    if missing or extra:
        raise ValueError(f"columns missing for {name}: {missing}; columns it does not have: {extra}")
    df.select(*target).write.insertInto(name, overwrite=overwrite)


def add_columns(spark: SparkSession, name: str, columns_ddl: str) -> None:
    """T4: add columns to a catalog table (``"discount_code string, loyalty int"``).

    Existing files keep working: readers see null in the new columns.
    Dropping or renaming columns is not supported by the session catalog's
    Parquet tables; project instead.
    """
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns_ddl})")


def register_lake(spark: SparkSession, root: str, namespace: str, tables: list[str] | None = None,
                  catalog: str = "spark_catalog") -> list[str]:
    """Register landed tables (``root/<table>``) as catalog tables ``catalog.namespace.table``.

    Any file system that Spark reads will do.  Without ``tables`` those of
    the model that are there are registered; a table asked for by name that
    is not there raises, as does a root without any.
    Schema and partition columns are read from the files; partition folders
    are recovered, so partition pruning works through SQL as well.  Returns
    the three-part names.  Re-registering replaces the table entries, never
    the data (the tables are external).
    """
    from pyspark.errors import AnalysisException

    create_namespace(spark, namespace, catalog)
    names = []
    for t in tables or specs.TABLE_ORDER:
        path = f"{root.rstrip('/')}/{t}"
        try:  # Spark's reader asks the path's own file system
            spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            if tables:
                raise FileNotFoundError(f"no landed table at {path}") from e
            continue
        name = f"{catalog}.{namespace}.{t}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(f"{namespace}.{t}", path=path, source="parquet")
        if any(c.isPartition for c in spark.catalog.listColumns(f"{namespace}.{t}")):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        names.append(name)
    if not names:
        raise FileNotFoundError(f"no landed table under {root}")
    return names


def create_external_table(spark: SparkSession, name: str, location: str, schema: T.StructType) -> None:
    """A catalog table over existing Parquet files with an explicit schema."""
    spark.catalog.createTable(name, path=location, source="parquet", schema=schema)


# Arrow type name -> Spark type.  Unknown types raise (no silent
# string fallback).
_ARROW_TO_SPARK = {
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "string": T.StringType(),
    "large_string": T.StringType(),
    "bool": T.BooleanType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date32[day]": T.DateType(),
    "timestamp[us]": T.TimestampNTZType(),
    "timestamp[ns]": T.TimestampNTZType(),
}


#: File systems that pyarrow opens by address; on others the files' footers cannot be read in tasks.
ADDRESSES = ("file:", "s3:", "s3a:", "gs:", "hdfs:")


def file_schemas(spark: SparkSession, path: str, suffix: str = ".parquet") -> DataFrame:
    """``(path, ordinal, column_name, data_type)`` of every data file below ``path``, from the files' own footers.

    The published inspector looks at the first file; here each task reads
    the footers of its share of the listing (a few KB a file, no rows) and
    names Spark's types by :func:`spark_type`.  An unknown type is an error,
    as is a file that is no Parquet.
    """
    listed = list_files(spark, path, suffix).select("path")
    first = listed.first().path
    if not first.startswith(ADDRESSES):
        raise ValueError(f"footers of {first} cannot be read in tasks: not on any of {ADDRESSES}")
    spread = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), listed.count() // 16))
    return listed.repartition(spread, "path").mapInArrow(_footers, "path string, ordinal int, column_name string, data_type string")


def _address(path: str) -> str:
    """Spark's path as pyarrow's address."""
    scheme, rest = path.split(":", 1)
    return f"file:///{rest.lstrip('/')}" if scheme == "file" else f"{'s3' if scheme == 's3a' else scheme}://{rest.lstrip('/')}"


def _footers(batches):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, inside = fs.FileSystem.from_uri(_address(path))
            with store.open_input_file(inside) as f:
                schema = pq.read_schema(f)
            yield pa.RecordBatch.from_pydict({
                "path": pa.array([path] * len(schema), pa.string()), "ordinal": pa.array(range(1, len(schema) + 1), pa.int32()),
                "column_name": pa.array(schema.names, pa.string()), "data_type": pa.array([spark_type(f.type).simpleString() for f in schema], pa.string())})


def schema_drift(schemas: DataFrame) -> DataFrame:
    """One row per (file, column) of :func:`file_schemas`, also for columns that a file lacks: ``(path, column_name, data_type,
    common_type, agrees)``.  ``common_type`` is the type that most files have for the column (the least name, if several)."""
    n = schemas.groupBy("column_name", "data_type").agg(F.count(F.lit(1)).alias("n"))
    common = n.groupBy("column_name").agg(F.min_by("data_type", F.struct(-F.col("n"), "data_type")).alias("common_type"))
    # a row per column of the table, held by the driver as part of the plan
    known = [F.struct(F.lit(r.column_name).alias("column_name"), F.lit(r.common_type).alias("common_type")) for r in common.orderBy("column_name").collect()]
    types = schemas.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("column_name", "data_type"))).alias("types"))
    each = types.select("path", "types", F.explode(F.array(*known)).alias("c")).select("path", "types", "c.*")
    found = F.try_element_at("types", F.col("column_name"))
    return each.select("path", "column_name", found.alias("data_type"), "common_type", F.coalesce(found == F.col("common_type"), F.lit(False)).alias("agrees"))


def spark_type(arrow_type) -> T.DataType:
    """Map a pyarrow type to the Spark type used for it."""
    import pyarrow as pa

    if pa.types.is_decimal(arrow_type):
        return T.DecimalType(arrow_type.precision, arrow_type.scale)
    if pa.types.is_timestamp(arrow_type) and arrow_type.tz is not None:
        return T.TimestampType()
    key = str(arrow_type)
    if key not in _ARROW_TO_SPARK:
        raise TypeError(f"unsupported column type {arrow_type}")
    return _ARROW_TO_SPARK[key]
