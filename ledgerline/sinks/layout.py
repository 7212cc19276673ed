"""Landing tables: conform, partitioned and sorted Parquet writes, reports.

Writes are single Spark jobs with one atomic job commit per table (the
output committer replaces the reference's per-chunk uploads and success
counting).  Clustering uses AQE's ``rebalance`` hint on the partition
columns: rows of one partition value go to the same writer tasks, and a
value that holds a large share of all rows is split over several tasks
instead of landing in one, so no single task writes a third of a table.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import os
import threading
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import specs

LAYOUTS = ("partitioned", "flat")
GRANULARITIES = ("day", "month", "year")

def conform(df: DataFrame, schema: T.StructType, allow_extra: bool = False,
            fill: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto ``schema``: cast and order.

    A column missing from ``df`` raises unless named in ``fill`` (then it
    is null).  Columns not in the schema raise unless ``allow_extra`` (then
    they are dropped).  Casts follow Spark's ANSI rules, so a value that does not fit
    fails the job instead of silently turning into a string or null.
    """
    have = {c.lower(): c for c in df.columns}
    extra = set(have) - {f.name.lower() for f in schema.fields}
    if extra and not allow_extra:
        raise ValueError(f"columns not in target schema: {sorted(extra)}")
    missing = [f.name for f in schema.fields if f.name.lower() not in have and f.name not in fill]
    if missing:
        raise ValueError(f"columns missing from the data: {missing}")
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        c = F.col(src) if src else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def partition_columns(table: str, granularity: str = "day") -> tuple[list[str], dict]:
    """Partition columns of a table and any derived columns they need.

    ``granularity="month"`` (``"year"``) replaces each ``*_date`` partition
    with ``<col>_month`` (``<col>_year``), the first day of the period:
    country x day gives thousands of small directories, country x month a
    few hundred.
    """
    if granularity not in GRANULARITIES:
        raise ValueError(f"unknown granularity {granularity!r}; expected one of {GRANULARITIES}")
    cols, derived = [], {}
    for c in specs.spec(table).partition_cols:
        if granularity != "day" and c.endswith("_date"):
            name = f"{c}_{granularity}"
            derived[name] = F.trunc(F.col(c), granularity)
            cols.append(name)
        else:
            cols.append(c)
    return cols, derived


def clustered(df: DataFrame, table: str, granularity: str = "day") -> tuple[DataFrame, list[str]]:
    """Cluster rows for a partitioned write (W7): rebalance on the partition
    columns, then sort each task's rows by partition and sort columns."""
    ts = specs.spec(table)
    pcols, derived = partition_columns(table, granularity)
    for name, expr in derived.items():
        df = df.withColumn(name, expr)
    missing = [c for c in pcols + list(ts.sort_cols) if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: partition/sort columns missing from data: {missing}")
    # A coarsened date folder (month/year) is sorted by the date itself next,
    # so row-group min/max statistics still skip by date inside each file.
    coarse_dates = [c for c in ts.partition_cols if c not in pcols and c.endswith("_date") and c in df.columns]
    order = pcols + [c for c in coarse_dates if c not in ts.sort_cols] + list(ts.sort_cols)
    balanced = df.hint("rebalance", *pcols) if pcols else df.hint("rebalance")
    return balanced.sortWithinPartitions(*order), pcols


def date_at_least(df: DataFrame, column: str, since) -> DataFrame:
    """``column >= since`` that also prunes coarsened date folders.

    On a table landed with ``<column>_month`` or ``<column>_year`` folders
    the same bound is applied to the folder column (truncated to the
    period), so Spark prunes folders as it would for daily ones.
    """
    import datetime as dt

    bound = dt.date.fromisoformat(since) if isinstance(since, str) else since
    out = df.filter(F.col(column) >= F.lit(bound))
    for g in ("month", "year"):
        folder = f"{column}_{g}"
        if folder in df.columns:
            start = bound.replace(day=1) if g == "month" else bound.replace(month=1, day=1)
            out = out.filter(F.col(folder) >= F.lit(start))
    return out


def write_table(df: DataFrame, path: str, table: str, profile: str = "lake", layout: str = "partitioned",
                mode: str = "overwrite", granularity: str = "day",
                max_records_per_file: int | None = 5_000_000, replace: str = "table",
                fill: tuple[str, ...] = (), target_file_bytes: int | None = None) -> dict:
    """Land one table as Snappy Parquet.

    ``layout="flat"`` is the base profile's one-folder layout;
    ``"partitioned"`` uses the table's partition spec; ``granularity``
    ``"day"`` is the published spec, ``"month"``/``"year"`` coarsen the date
    folders on request; neither depends on the table's size.  ``replace="partitions"`` overwrites only the partitions
    present in ``df`` (a partial re-run); the default replaces the table.
    Declared columns that ``df`` lacks are null if named in ``fill``.
    ``target_file_bytes`` is what a writer task of a partitioned layout takes
    in at most (shuffled bytes, which Parquet then packs further): folders
    above it are split over several files, tasks below it take several folders.
    Returns a report row: ``written`` rows counted by the writing job itself,
    ``rows`` and ``files`` that ``path`` holds afterwards by its footers.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}; expected one of {LAYOUTS}")
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    if replace not in ("table", "partitions"):
        raise ValueError("replace must be 'table' or 'partitions'")
    df = conform(df, specs.spec(table).schema(profile), fill=fill)
    writer_df, pcols = (clustered(df, table, granularity) if layout == "partitioned"
                        else (df.sortWithinPartitions(*specs.spec(table).sort_cols), []))
    # the count is taken in the writing job, so a task that ran twice and left both files shows against the footers
    seen = Observation(f"landed-{table}-{uuid.uuid4().hex}")
    w = writer_df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", "snappy")
    w = w.option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if pcols:
        w = w.partitionBy(*pcols)
    with _advisory_size(df.sparkSession, target_file_bytes):
        w.parquet(path)
    rows, files = landed(df.sparkSession, path)
    kind = granularity if pcols else ("unpartitioned" if layout == "partitioned" else "flat")
    return {"table": table, "path": path, "rows": rows, "files": files, "written": seen.get["rows"], "partition_cols": pcols, "granularity": kind}


_SIZES = ("spark.sql.adaptive.coalescePartitions.minPartitionSize", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
_writers, _writers_lock = {}, threading.Lock()


@contextlib.contextmanager
def _advisory_size(spark: SparkSession, size: int | None):
    """Sizes that adaptive execution aims at when it splits and joins a writer's partitions.

    ``size`` bounds a task's share.  Without one the session's size stays, and only the least size is lowered: a
    small table of many folders is then written by as many tasks as there are cores, since opening files costs more than
    bytes there.  Writes that run side by side share the settings; the last to end restores them."""
    with _writers_lock:
        if not _writers:
            _writers.update({k: spark.conf.get(k, None) for k in _SIZES} | {"running": 0})
        _writers["running"] += 1
        spark.conf.set(_SIZES[0], str(max(1024, size // 4) if size else 1024))
        if size:
            spark.conf.set(_SIZES[1], str(size))
    try:
        yield
    finally:
        with _writers_lock:
            _writers["running"] -= 1
            if not _writers["running"]:
                for k in _SIZES:
                    spark.conf.unset(k) if _writers[k] is None else spark.conf.set(k, _writers[k])
                _writers.clear()


def landed(spark: SparkSession, path: str) -> tuple[int, int]:
    """(rows, data files) of a landed folder.  Rows come from the files'
    footers (a count without columns), files from Spark's own listing."""
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    return df.count(), len(df.inputFiles())


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int = 100, path: str | None = None,
                   mode: str = "overwrite") -> int:
    """Hash-bucket a table on a high-cardinality key, sorted by it.

    Two tables bucketed the same way on the join key join without a
    shuffle.  Needs a catalog table (``saveAsTable``).  Rows are first
    hash-partitioned on the key into exactly ``buckets`` partitions (the
    same hash Spark uses for bucket ids), so each task writes one bucket:
    without it every task writes a file per bucket (120K tasks x 512
    buckets = 61M files at 100 TB).  ``maxRecordsPerFile`` splits big
    buckets into several files.  Returns the rows that the writing job counted.
    """
    seen = Observation(f"bucketed-{uuid.uuid4().hex}")
    w = (df.repartition(buckets, key).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("maxRecordsPerFile", 5_000_000)
         .bucketBy(buckets, key).sortBy(key).format("parquet"))
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return seen.get["rows"]


def read_table(spark: SparkSession, path: str, table: str | None = None, profile: str = "lake") -> DataFrame:
    """Read a landed table; with ``table`` the declared schema is enforced: a
    missing column raises, and so does one that neither the schema nor a
    coarsened date folder accounts for."""
    r = spark.read.option("pathGlobFilter", "*.parquet")
    df = r.parquet(path)
    if table:
        schema = specs.spec(table).schema(profile)
        folders = {f"{c}_{g}" for c in specs.spec(table).partition_cols for g in ("month", "year")}
        df = conform(df.drop(*(folders - set(schema.fieldNames()))), schema)
    return df


MANIFEST_SCHEMA = T.StructType([
    T.StructField("generation_date", T.StringType()),
    T.StructField("target_size_gb", T.DoubleType()),
    T.StructField("tables", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("root", T.StringType()),
    T.StructField("chunk_size", T.LongType()),
    T.StructField("data_format", T.StringType()),
    T.StructField("compression", T.StringType()),
    T.StructField("profile", T.StringType()),
    T.StructField("table_rows", T.MapType(T.StringType(), T.LongType())),
])


def manifest_row(root: str, target_size_gb: float, profile: str, reports: list[dict] | None = None,
                 generated_at: str | None = None) -> dict:
    """The manifest as a plain dict (one row of :data:`MANIFEST_SCHEMA`)."""
    return {
        "generation_date": generated_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(),
        "target_size_gb": float(target_size_gb),
        "tables": {t: float(r) for t, r in specs.SIZE_RATIOS.items()},
        "root": root,
        "chunk_size": specs.CHUNK_ROWS[profile],
        "data_format": "parquet",
        "compression": "snappy",
        "profile": profile,
        "table_rows": {r["table"]: int(r["rows"]) for r in (reports or []) if r.get("rows") is not None},
    }


def write_manifest(spark: SparkSession, root: str, manifest: dict) -> str:
    """Write the manifest as a one-row JSON table at ``root/_manifest``
    (the leading underscore hides it from table readers)."""
    path = os.path.join(root, "_manifest")
    spark.createDataFrame([manifest], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(path)
    return path


def read_manifest(spark: SparkSession, root: str) -> dict:
    row = spark.read.schema(MANIFEST_SCHEMA).json(os.path.join(root, "_manifest")).first()
    return row.asDict(recursive=True)
