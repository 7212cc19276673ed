"""Re-running a part of a landed table: its partitions are replaced, every other folder keeps its files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path
from ledgerline.sinks import audit, layout


class StaleFolders(ValueError):
    """Folders of the re-run's scope hold rows that the re-run no longer has."""


def rerun(df: DataFrame, path: str, table: str, scope: str, granularity: str = "day", profile: str = "lake",
          fill: tuple[str, ...] = ()) -> tuple[dict, DataFrame]:
    """Replace the rows of ``path`` that meet ``scope`` by ``df``: the write's report, and per folder what became of its files.

    ``scope`` is an SQL condition on partition columns (coarsened ones
    too), such as ``order_date_year = DATE'1998-01-01'``.  The new rows must
    all meet it: rows beyond would replace folders that nobody asked for, so
    they raise before anything is written.  Spark's dynamic partition
    overwrite then replaces exactly the folders that ``df`` has rows for, in
    one commit.

    A folder of the scope without new rows would keep its old ones.  Such
    folders raise :class:`StaleFolders` before anything is written; land
    them empty by hand (``ALTER TABLE ... DROP PARTITION`` on the catalog
    table), since a file listing can't be emptied by a write.
    """
    spark = df.sparkSession
    absent = [c for c in fill if c in df.columns]
    if absent:
        raise ValueError(f"columns to fill are in the data: {absent}")
    pcols, derived = layout.partition_columns(table, granularity)
    keyed = df.withColumns(derived) if derived else df
    beyond = keyed.where(~F.coalesce(F.expr(scope), F.lit(False)))
    if not beyond.isEmpty():
        raise ValueError(f"{table}: rows of the re-run do not meet {scope!r}")
    landed = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    old = landed.where(scope).select(*pcols).distinct()
    new = keyed.select(*[F.col(c).cast(landed.schema[c].dataType).alias(c) for c in pcols]).distinct()
    stale = old.exceptAll(new)
    if not stale.isEmpty():
        raise StaleFolders(f"{table}: folders without new rows, such as {stale.first()}")
    before = listing(spark, path)
    report = layout.write_table(df, path, table, profile, granularity=granularity, replace="partitions", fill=fill)
    return report, audit.kept_files(before, listing(spark, path))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path`` as they are now, written down: a listing that is made again would see later files."""
    kept = scratch_path(spark, "listing")
    audit.files(spark, path).write.parquet(kept)
    return spark.read.parquet(kept)
