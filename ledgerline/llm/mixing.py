"""Mixing sources to target weights: blocks of words, multinomial shards, permuted block indexes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, materialise, shuffle_partitions, text_of

#: A source is repeated up to so many times.
MOST = 3
#: Blocks that a source has at least, so that its taken words come within half a hundredth of its size to the target.
LEAST_BLOCKS = 128
#: Weights by the sources' order, repeating.
WEIGHTS = (1, 2, 3)


@dataclass
class Plan:
    """Per source, in order: name, words, target, words of a block, blocks, slots (block draws of the whole mix)."""

    names: list[str | None]
    sizes: np.ndarray
    targets: np.ndarray
    block_words: np.ndarray
    blocks: np.ndarray
    slots: np.ndarray


def targets(sizes: list[int], weights: list[float]) -> list[float]:
    """Shares of all words by weight; no source above MOST times its size, the excess reshared until none is."""
    left, total = set(range(len(sizes))), float(sum(sizes))
    out = [0.0] * len(sizes)
    while left:
        weight = sum(weights[i] for i in left)
        above = [i for i in left if total * weights[i] / weight > MOST * sizes[i]]
        for i in above or left:
            out[i] = float(MOST * sizes[i]) if above else total * weights[i] / weight
        if not above:
            break
        left -= set(above)
        total -= sum(out[i] for i in above)
    return out


def make_plan(sizes: dict[str | None, int], block_words: int) -> Plan:
    """Blocks have ``block_words`` words; sources of less than LEAST_BLOCKS such blocks have shorter ones, as many as that, so
    that a whole number of blocks comes near any target."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    words = [int(sizes[n]) for n in names]
    goal = targets(words, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))])
    lengths = [max(1, min(block_words, w // LEAST_BLOCKS)) for w in words]
    blocks = [-(-w // n) for w, n in zip(words, lengths, strict=True)]
    slots = []
    for w, t, n, b in zip(words, goal, lengths, blocks, strict=True):
        whole = min(MOST, int(t // w)) if w else 0  # times that every block is drawn
        slots.append(whole * b + (min(b, round((t - whole * w) / n)) if whole < MOST else 0))
    return Plan(names, np.array(words, np.int64), np.array(goal), *(np.array(x, np.int64) for x in (lengths, blocks, slots)))


def _mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The images of ``index`` under a pseudorandom permutation of 0..n-1: a four-round Feistel network over the
    next even number of bits, walked on while it leads outside. No table: any index is mapped on its own."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)

    def once(x):
        left, right = x >> half, x & mask
        for r in range(4):
            salt = np.uint64((key * 4 + r) * 0x9E3779B97F4A7C15 % 2**64)
            left, right = right, left ^ (_mix64(right + salt) & mask)
        return (left << half) | right

    out = once(index.astype(np.uint64))
    while (outside := out >= n).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def _draw(slots: int, shard_slots: int, share: np.ndarray, seed: int):
    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shard, source, n = [], [], []
            for k in batch["id"]:
                counts = np.random.default_rng([seed, int(k)]).multinomial(min(shard_slots, slots - int(k) * shard_slots), share)
                some = np.flatnonzero(counts)
                shard += [int(k)] * len(some)
                source += some.tolist()
                n += counts[some].tolist()
            yield pd.DataFrame({"shard": shard, "source_no": source, "n": n}, dtype="int64")

    return draw


def _place(plan: Plan, drawn: np.ndarray, seed: int):
    """Slots -> blocks. Draws of a source beyond its slots go, in order, to the sources that were drawn too seldom."""
    excess, short = np.maximum(drawn - plan.slots, 0), np.maximum(plan.slots - drawn, 0)
    excess_from, short_to = np.cumsum(excess) - excess, np.cumsum(short)

    def blocks_of(source: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(source, n)
        slot = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        over = slot >= plan.slots[owner]
        if over.any():
            at = excess_from[owner[over]] + slot[over] - plan.slots[owner[over]]
            to = np.searchsorted(short_to, at, side="right")
            slot[over], owner[over] = drawn[to] + at - (short_to[to] - short[to]), to
        epoch, block = np.divmod(slot, plan.blocks[owner])
        for s, e in np.unique(np.stack([owner, epoch]), axis=1).T if len(owner) else []:
            at = (owner == s) & (epoch == e)
            block[at] = permute(block[at], int(plan.blocks[s]), seed * 1_000_003 + int(s) * MOST + int(e))
        return owner, block

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), 256):  # a row has at most a shard's slots
                part = batch.iloc[k : k + 256]
                n = part["n"].to_numpy()
                owner, block = blocks_of(part["source_no"].to_numpy(), part["first"].to_numpy(), n)
                yield pd.DataFrame({"source_no": owner, "block": block, "shard": np.repeat(part["shard"].to_numpy(), n)})

    return place


def _running(rows: DataFrame, keys: list[str], group: str, order: list[str], value: str, into: str) -> DataFrame:
    """Adds ``into``: the sum of ``value`` over the rows before, within ``keys``, ordered by ``group`` and ``order``.

    In two levels, so that no task orders all rows of a key: sums per group first, then within each group."""
    before = Window.partitionBy(*keys).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    groups = rows.groupBy(*keys, group).agg(F.sum(value).alias("_sum")).withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(groups.hint("merge"), [*keys, group]).withColumn(into, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_base")


def _levels(n: int) -> int:
    """Bits that number about sqrt(n) groups of about sqrt(n) rows."""
    return max(1, math.ceil(math.log2(max(2, n)) / 2))


def _dealt(docs: DataFrame, id_col: str, text_col: str, source_col: str, block_words: int, shard_slots: int, seed: int) -> tuple[DataFrame, DataFrame, Plan]:
    """(packed, slots, plan): every input row with its place ``start`` among its source's words, and the mix's draws of blocks."""
    spark = docs.sparkSession
    text = text_of(text_col)
    rows = materialise(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(F.col(id_col), text).alias("tie")),
        "op5-rows",
    )
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    plan = make_plan({r["source"]: r["size"] for r in found}, block_words)
    numbers = spark.createDataFrame(
        [(n, i, int(s), float(t), int(b)) for i, (n, s, t, b) in enumerate(zip(plan.names, plan.sizes, plan.targets, plan.block_words, strict=True))],
        "of_source string, source_no long, source_size long, target double, block_words long",
    )
    rows = rows.join(numbers, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    bits = _levels(sum(r["n"] for r in found))
    packed = _running(rows.withColumn("grp", F.shiftrightunsigned("tie", 64 - bits)), ["source_no"], "grp", ["tie", "id", "size"], "size", "start")
    packed = materialise(packed.drop("grp"), "op5-packed")

    slots_n = int(plan.slots.sum())
    shards = -(-slots_n // shard_slots)
    share = plan.slots / max(1, slots_n)
    counts = spark.range(shards).mapInPandas(_draw(slots_n, shard_slots, share, seed), "shard long, source_no long, n long")
    counts = materialise(counts, "op5-shards")
    drawn = np.zeros(len(plan.names), np.int64)
    for r in counts.groupBy("source_no").agg(F.sum("n").alias("n")).collect():
        drawn[r.source_no] = r.n
    wide = 1 << _levels(shards)
    numbered = _running(counts.withColumn("grp", F.expr(f"shard div {wide}")), ["source_no"], "grp", ["shard"], "n", "first").drop("grp")
    # by number, so that rows of few bytes but many slots are not put together in a few tasks
    spread = max(shuffle_partitions(spark), slots_n // 1_000_000)
    slots = numbered.repartition(spread, "shard", "source_no").mapInPandas(_place(plan, drawn, seed), "source_no long, block long, shard long").select("shard", "source_no", "block")
    return packed, slots, plan


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = 256, shard_slots: int = 1024, seed: int = 20) -> tuple[DataFrame, DataFrame, Plan]:
    """(documents, slots, plan). ``documents``: one row per input row, (id, source, size, source_size, target, taken).
    ``slots``: the mix itself, one row per place, (shard, source_no, block), blocks of ``block_words`` words (fewer in
    small sources, see make_plan) of a source's documents in the order of a hash. ``plan``: the sources, their targets and draws.

    A source's words are packed end to end into blocks. Each output shard draws how many of its slots every source
    gets, from a multinomial at the targets' shares; a slot's number within its source gives, through that source's
    permutation for each round over its blocks, the block. Draws beyond a source's slots pass to sources short of
    theirs, so the whole mix holds each source's target up to a block or two. A source whose target is k times its
    size has every block k times, and no block is drawn more than MOST times, so no document is either.

    Null texts have size 0 and are never taken; null is a source, the last. Repeated rows are packed each; equal ids
    need not be unique. Empty tables and tables without words give targets of 0. Every draw depends on ``seed``, the
    texts and ids alone, so reruns and other partitionings agree. The driver holds a few numbers per source.
    Documents and slots are numbered in two levels of about sqrt(n) rows, whatever share a source has.
    """
    packed, slots, plan = _dealt(docs, id_col, text_col, source_col, block_words, shard_slots, seed)
    draws = slots.groupBy("source_no", "block").agg(F.count("*").alias("draws"))
    end = F.col("start") + F.col("size")
    parts = packed.where("size > 0").select(
        "source_no", "start", "size", "block_words", F.explode(F.expr("sequence(start div block_words, (start + size - 1) div block_words)")).alias("block")
    )
    width = F.col("block_words")
    parts = parts.withColumn("words", F.least(end, (F.col("block") + 1) * width) - F.greatest(F.col("start"), F.col("block") * width))
    taken = parts.join(draws.hint("merge"), ["source_no", "block"]).groupBy("source_no", "start").agg(F.sum(F.col("words") * F.col("draws")).alias("taken"))
    empty = F.when(F.col("size") > 0, F.col("start")).alias("at")
    taken = taken.withColumnRenamed("start", "at")
    documents = (
        packed.withColumn("at", empty)
        .join(taken.hint("merge"), ["source_no", "at"], "left")
        .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )
    return documents, slots, plan


def mix_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = 256, shard_slots: int = 1024, seed: int = 20) -> DataFrame:
    """The mixed corpus itself: one row per passage of a document in it, (shard, place, at, id, source, first, words, text).

    ``place`` numbers the blocks of a shard, ``at`` is the passage's first word in its block, ``first`` that in its
    document; ``text`` has its words, joined by blanks. A block is the passages of its place, by ``at``: ``block_words``
    words of one source, fewer in small sources and in a source's last block. Shards are in order within tasks, and whole.

    Draws are those of ``mix_sources`` with the same parameters: a document's words here add up to its ``taken``. Blocks
    are joined to slots by (source, block), so a passage moves once to its block's draws and once to its shard. Null and
    empty texts have no passages; repeated rows have theirs each; other columns are not read."""
    packed, slots, _ = _dealt(docs, id_col, text_col, source_col, block_words, shard_slots, seed)
    text = text_of(text_col)
    source = F.col(source_col).cast("string")
    texts = docs.select(F.col(id_col).alias("of_id"), source.alias("of_source"), F.xxhash64(F.col(id_col), text).alias("of_tie"), text.alias("text"))
    # dealt once, by the tie: repeated rows, which are packed each but have one text, and the join are both in order with that
    texts = texts.repartition("of_tie").dropDuplicates(["of_tie", "of_id", "of_source"])
    # a sum, which Spark doesn't turn into further join keys: those would deal the texts anew
    own = F.col("id").eqNullSafe(F.col("of_id")).cast("int") + F.col("source").eqNullSafe(F.col("of_source")).cast("int") == 2
    rows = packed.where("size > 0").join(texts.hint("merge"), (F.col("tie") == F.col("of_tie")) & own).withColumn("all", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))

    def passage(block: Column) -> Column:
        begin = F.greatest(F.col("start"), block * F.col("block_words"))
        n = (F.least(F.col("start") + F.col("size"), (block + 1) * F.col("block_words")) - begin).cast("int")
        first = (begin - F.col("start")).cast("int")
        words = F.array_join(F.slice("all", first + 1, n), " ")
        return F.struct(block.alias("block"), (begin - block * F.col("block_words")).cast("int").alias("at"), first.alias("first"), n.alias("words"), words.alias("text"))

    blocks = F.expr("sequence(start div block_words, (start + size - 1) div block_words)")
    passages = rows.select("id", "source", "source_no", F.explode(F.transform(blocks, passage)).alias("p")).select("id", "source", "source_no", "p.*")
    in_shard = Window.partitionBy("shard").orderBy(F.xxhash64("shard", "source_no", "block", F.lit(seed)), "source_no", "block")
    placed = slots.withColumn("place", F.row_number().over(in_shard)).select("shard", "place", F.col("source_no").alias("of_no"), F.col("block").alias("of_block"))
    placed = materialise(placed, "op5-slots")
    mixed = passages.join(placed.hint("merge"), (F.col("source_no") == F.col("of_no")) & (F.col("block") == F.col("of_block")))
    mixed = mixed.select("shard", "place", "at", F.col("id").alias(id_col), "source", "first", "words", "text")
    return mixed.repartition("shard").sortWithinPartitions("shard", "place", "at")
