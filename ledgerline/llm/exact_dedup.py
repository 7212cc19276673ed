"""Exact duplicates through an extendible-hash index on shared files (DataFrame operations only)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import lower_ascii, materialise, shuffle_partitions, text_of

KEY_BITS = 64


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, KEY_BITS - depth) if depth else F.lit(0).cast("long")


def build_directory(entries: DataFrame, capacity: int, start_depth: int, max_depth: int) -> DataFrame:
    """The directory of the index over ``entries(key)``: one row per bucket, (depth, prefix), where the bucket
    holds the keys whose first ``depth`` bits are ``prefix``.

    The directory starts with 2**start_depth buckets. While a bucket holds more than ``capacity`` entries the
    directory doubles, and only the overfull buckets split. At ``max_depth`` a bucket stays as it is and its
    entries form a longer chain: nothing is dropped. Only counts per key prefix take part, at most 2**max_depth
    rows whatever the input.
    """
    cells = materialise(entries.groupBy(_prefix(F.col("key"), max_depth).alias("cell")).agg(F.count("*").alias("n")), "op1-cells")
    live, buckets, depth = cells, None, start_depth
    while True:
        sized = live.groupBy(F.shiftrightunsigned("cell", max_depth - depth).alias("prefix")).agg(F.sum("n").alias("n"))
        overfull = sized.where((F.col("n") > capacity) & F.lit(depth < max_depth)).select(F.col("prefix").alias("over"))
        full = sized.where((F.col("n") <= capacity) | F.lit(depth >= max_depth)).select(F.lit(depth).alias("depth"), "prefix", "n")
        buckets = full if buckets is None else buckets.unionByName(full)
        if overfull.isEmpty():
            return materialise(buckets, "op1-directory")
        live = live.join(overfull, F.shiftrightunsigned("cell", max_depth - depth) == F.col("over"), "left_semi")
        depth += 1


@dataclass(frozen=True)
class Index:
    """entries: the index files, one row per distinct text. directory: (pointer, of_bucket), the bucket that the keys with this
    prefix of ``depth`` bits are in."""

    entries: DataFrame
    directory: DataFrame
    depth: int

    def bucket_of(self, rows: DataFrame, key: str) -> DataFrame:
        """Adds of_bucket: from a row's key by the directory's pointer to the bucket."""
        return rows.join(self.directory, _prefix(F.col(key), self.depth) == F.col("pointer")).drop("pointer")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 65536, max_depth: int = 20) -> Index:
    """The index: its files have one row per distinct normalised text, (bucket, key, chain_no, text_sha256, keep_id, group_size).

    Equal texts are combined inside each map task before anything moves, so a text that makes up a third of the
    rows travels once per task. The reducer that owns a key compares the bytes of the texts under it: the group-by
    runs on key and text, so texts that collide on the 64-bit key stay apart. Entries are then dealt to the owners of
    their buckets, as the directory says: an owner has whole buckets, none of more than ``capacity`` entries unless
    its keys cannot be told apart by ``max_depth`` bits; it chains the entries of one key and writes them by bucket and key.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), lower_ascii(text_of(text_col)).alias("norm"))
    entries = materialise(
        rows.groupBy(F.xxhash64("norm").alias("key"), "norm")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("key", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"),
        "op1-entries",
    )
    start = min(max_depth, math.ceil(math.log2(max(2, shuffle_partitions(spark)))))
    directory = build_directory(entries, capacity, start, max_depth)
    depths = directory.agg(F.max("depth")).first()[0]
    depth = start if depths is None else depths
    pointers = directory.select(
        F.explode(F.expr(f"sequence(shiftleft(prefix, {depth} - depth), shiftleft(prefix + 1, {depth} - depth) - 1)")).alias("pointer"),
        F.concat_ws(":", "depth", "prefix").alias("of_bucket"),
    )
    index = Index(entries, materialise(pointers, "op1-pointers"), depth)
    owned = index.bucket_of(entries, "key").withColumnRenamed("of_bucket", "bucket").repartition("bucket")
    chain = Window.partitionBy("bucket", "key").orderBy("text_sha256")
    owned = owned.withColumn("chain_no", F.row_number().over(chain)).select("bucket", "key", "chain_no", "text_sha256", "keep_id", "group_size")
    return Index(materialise(owned.sortWithinPartitions("bucket", "key", "chain_no"), "op1-index"), index.directory, depth)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 65536, max_depth: int = 20) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, bucket, chain_no.

    Texts are equal when identical after lower-casing A-Z; the largest id of a group stays. A null text counts as
    empty. Null ids lose against any other id; in a group of null ids only, keep_id is null and the rows are kept.
    Repeated rows of one id are the same document: each is reported, and all of them are kept if the id is.
    An empty table gives an empty result. Other columns are not read. A row is looked up as in any extendible hash: by
    its key's prefix to the directory's pointer, from there to the bucket, and in the bucket by key and digest.
    """
    index = build_index(docs, id_col, text_col, capacity, max_depth)
    entries = index.entries.select("bucket", "key", F.col("text_sha256").alias("sha"), "keep_id", "group_size", "chain_no")
    norm = lower_ascii(text_of(text_col))
    probe = index.bucket_of(docs.select(F.col(id_col).alias("id"), F.xxhash64(norm).alias("probe_key"), F.sha2(norm, 256).alias("text_sha256")), "probe_key")
    found = (F.col("of_bucket") == F.col("bucket")) & (F.col("probe_key") == F.col("key")) & (F.col("text_sha256") == F.col("sha"))
    return probe.join(entries, found).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "bucket", "chain_no"
    )
