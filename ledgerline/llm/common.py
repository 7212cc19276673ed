"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of the white-space contracts, as a regular expression.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only. All-ASCII texts take Spark's fast path, others go code point by code point."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_of(column: str = "text") -> Column:
    """The column as text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir. Without that setting a temporary folder is used in a
    local session only, where driver and tasks are one process; any other master is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to shared storage and reads it back: cuts the lineage, outlives lost executors, and
    gives later joins a plain scan, whose skewed partitions adaptive execution can split."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one run, in a folder of its own on shared storage, each deleted once it is spent.

    A table is dropped when what was made of it is written: nothing that can be lost afterwards needs it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.count = spark, shared_dir(spark, name), 0

    def keep(self, df: DataFrame, table: str) -> DataFrame:
        """As ``materialise``; ``table`` names it for ``drop``, a later table of that name is another one."""
        self.count += 1
        path = f"{self.root}/{table}-{self.count}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: str) -> None:
        """Deletes all tables of these names."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        files = root.getFileSystem(conf)
        for table in tables:
            for found in files.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"{table}-*")) or []:
                files.delete(found.getPath(), True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
