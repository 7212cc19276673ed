"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on: AQE for runtime coalescing and skew
# splitting, UTC so date/timestamp casts are stable, no UI server.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(master: str | None = None, app: str = "ledgerline",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir``. Only a local session without one
    gets a fresh local folder (driver and tasks are one process there); on
    any other master it is an error, as executors write to disks of their own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def scale_conf(input_bytes: int, total_cores: int, max_shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings for a job reading ``input_bytes`` on ``total_cores`` cores.

    - Scan splits of 256 MB: 100 TB become ~400K scan tasks.
    - AQE starts every shuffle with enough partitions for ~256 MB each
      (at least two per core; ``max_shuffle_partitions`` bounds the count
      for drivers that cannot track as many) and coalesces small ones
      at run time; skewed partitions of joins and rebalances are split.
    - Broadcast only below Spark's size check of 64 MB.
    """
    mb256 = 256 * 1024 * 1024
    initial = max(2 * total_cores, -(-input_bytes // mb256))
    if max_shuffle_partitions is not None:
        initial = min(initial, max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(mb256),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(mb256),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
