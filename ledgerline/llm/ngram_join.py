"""Jaccard join of word n-gram sets by PartEnum signatures (partitions, and subsets of each one's cells), and the components of its links."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm import wordhash
from ledgerline.llm.common import Scratch

#: Size bands: the largest set of a band has at most BAND times the elements of its smallest.
BAND = 1.3
#: Cells of a partition, of which all subsets without one cell sign.
CELLS = 3
#: Partitionings tried for sets with too few rich partitions.
SEEDS = 8
#: Documents looked at for signatures that very many share, the share that counts as many, and the tasks for such a one.
HOT_SAMPLE, HOT_SHARE, HOT_TASKS = 4_000, 0.005, 64
#: Members of a block when a group is compared.
BLOCK = 128


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of n words, A-Z lower-cased; of all words if there are fewer."""
    words = wordhash.word_hashes(wordhash.encode(text, lower=True))
    if not len(words):
        return words
    size = min(n, len(words))
    return np.unique(wordhash.gram_hashes(words, size) + np.uint64(size))


def set_key(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    one = wordhash.mix(elements ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = wordhash.mix(elements * np.uint64(0xD1342543DE82EF95) + np.uint64(7)).sum(dtype=np.uint64)
    return int(np.uint64(one).view(np.int64)), int(np.uint64(two).view(np.int64))


def _spare(need: int, poor) -> int:
    """Partitions to add to ``need``, so that as many are left when the expected ``poor(n)`` of all n, and some more, are not rich."""
    n = need
    while n < 4 * need + 8:
        lost = poor(n)
        if n >= need + lost + 1.5 * lost**0.5:
            break
        n += 1
    return n - need


class Bands:
    """PartEnum for bands of set sizes. Two sets of Jaccard similarity >= percent/100 share a signature of the smaller one's band.

    For band [low, high], ``differ`` bounds the elements in which a set of the band and a similar set at least as large
    can differ: (100 - percent) / (100 + percent) of both sizes' sum. The element domain is cut into ``parts``
    partitions, each into CELLS cells; the signatures are the contents of all subsets of CELLS - 1 cells of each
    partition. A partition in which the two sets differ in one element or none has such a subset with the same
    elements in both, and at most differ // 2 partitions differ in more. So one of any differ // 2 + 1 partitions
    gives a common signature; where every subset of those holds an element of one of the sets, it is no empty one.
    """

    def __init__(self, percent: int, cells: int = CELLS):
        self.percent, self.cells, self.bands = percent, cells, []
        self.least = min(2, cells)  # filled cells of a rich partition; differences that spoil one

    def band(self, size: int) -> int:
        while not self.bands or self.bands[-1][1] < size:
            low = self.bands[-1][1] + 1 if self.bands else 1
            high = max(low, int(low * BAND)) if low > 5 else low
            differ = (100 - self.percent) * (high + high * 100 // self.percent) // (100 + self.percent)
            need = differ // self.least + 1

            def poor(n: int, low: int = low) -> float:
                """Expected partitions of n that are not rich."""
                cell = np.exp(-low / n / self.cells)  # empty, for elements that fall at random
                return n * sum(math.comb(self.cells, k) * (1 - cell) ** k * cell ** (self.cells - k) for k in range(self.least))

            self.bands.append((low, high, need, need + _spare(need, poor)))
        sizes = [b[1] for b in self.bands]
        return int(np.searchsorted(sizes, size))

    def of_set(self, size: int) -> list[int]:
        """Bands in which a set of this size can meet a similar one: its own, and those of smaller similar sets."""
        return list(range(self.band(-(-size * self.percent // 100)), self.band(size) + 1))

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        """The set's signatures: per band, partition and subset of its cells the hash of the elements there, if there are any.

        A set with ``need`` rich partitions (elements in two cells at least, so no subset is empty) shares one that is
        not empty with every similar set of the band. Others sign by further partitionings too, as similar sets of
        their kind do; in the last such a set signs empty subsets as well, so no pair is lost."""
        out = []
        for b in self.of_set(len(elements)):
            _, _, need, parts = self.bands[b]
            for seed in range(SEEDS):
                scattered = wordhash.mix(elements ^ np.uint64((b * SEEDS + seed + 1) * 0x9E3779B97F4A7C15 % 2**64))
                cell = ((scattered >> np.uint64(32)) * np.uint64(parts * self.cells) >> np.uint64(32)).astype(np.int64)
                again = wordhash.mix(scattered + np.uint64(1))
                # sums of 32-bit halves are exact in doubles
                low = np.bincount(cell, (again & np.uint64(0xFFFFFFFF)).astype(np.float64), parts * self.cells).astype(np.uint64)
                high = np.bincount(cell, (again >> np.uint64(32)).astype(np.float64), parts * self.cells).astype(np.uint64)
                sums = (low + (high << np.uint64(32)) + (high >> np.uint64(32))).reshape(parts, self.cells)
                filled = np.bincount(cell, minlength=parts * self.cells).reshape(parts, self.cells) > 0
                if self.cells > 1:  # all cells but one
                    subset, any_in = sums.sum(axis=1, keepdims=True, dtype=np.uint64) - sums, filled.sum(axis=1, keepdims=True) - filled > 0
                else:
                    subset, any_in = sums, filled
                number = (np.arange(subset.size, dtype=np.uint64).reshape(subset.shape) << np.uint64(20)) + np.uint64(b * SEEDS + seed)
                signs = wordhash.mix(wordhash.mix(subset) + number)
                rich = int((filled.sum(axis=1) >= self.least).sum()) >= need
                out.append(signs.ravel() if not rich and seed == SEEDS - 1 else signs[any_in])
                if rich:
                    break
        return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


@cache
def _bands(percent: int, cells: int = CELLS) -> Bands:
    return Bands(percent, cells)


def sketch(elements: np.ndarray) -> bytes:
    """A bit per cell, telling if the cell holds an odd number of elements; cells grow in number with the set.

    An element in only one of two sets flips one cell, so the cells that differ are at most the elements that do."""
    cells = 1 << max(8, (2 * len(elements)).bit_length())
    at = (wordhash.mix(elements + np.uint64(11)) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=cells) & 1, bitorder="little").tobytes()


def _same_cells(sketches: list[bytes], size: int) -> np.ndarray:
    """The sketches over ``size`` bytes of cells: cells that are equal modulo the smaller number are joined."""
    out = np.empty((len(sketches), size // 8), np.uint64)
    for i, s in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, size // 8), axis=0)
    return out


def _compare(percent: int):
    """Pairs of members of two blocks that are in different components and may be similar, by sizes and sketches."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [np.zeros((0, 2), np.int64)]
            for r in batch.itertuples(index=False):
                size = min(map(len, [*r.sketches, *r.other_sketches]))
                x, y = _same_cells(r.sketches, size), _same_cells(r.other_sketches, size)
                for i in range(len(x)):
                    both = r.sizes[i] + r.other_sizes
                    near = np.bitwise_count(x[i] ^ y).sum(axis=1) <= (100 - percent) * both // (100 + percent)
                    fits = 100 * np.minimum(r.sizes[i], r.other_sizes) >= percent * np.maximum(r.sizes[i], r.other_sizes)
                    at = np.flatnonzero(near & fits & (r.labels[i] != r.other_labels))
                    pair = np.stack([np.full(len(at), r.classes[i]), r.other_classes[at]], axis=1)
                    out.append(np.sort(pair, axis=1))
            yield pd.DataFrame(np.unique(np.concatenate(out), axis=0), columns=["a", "b"])

    return compare


def _describe(n: int):
    @F.pandas_udf("size long, lo long, hi long, sketch binary")
    def describe(text: pd.Series) -> pd.DataFrame:
        sets = [shingles(t, n) for t in text]
        return pd.DataFrame([(len(s), *set_key(s), sketch(s)) for s in sets], columns=["size", "lo", "hi", "sketch"])

    return describe


def _sign(n: int, percent: int, cells: int, hot: np.ndarray):
    """(signature, task, id): one row per signature of each set; sets equal to one before in the batch don't sign again."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = _bands(percent, cells)
        for batch in batches:
            seen, ids, signs = set(), [], []
            for id_, text in zip(batch["id"], batch["text"], strict=True):
                elements = shingles(text, n)
                if not len(elements) or (key := set_key(elements)) in seen:
                    continue
                seen.add(key)
                signs.append(bands.signatures(elements))
                ids.append(np.full(len(signs[-1]), id_, np.int64))
            if not signs:
                continue
            sign_, id_ = np.concatenate(signs), np.concatenate(ids)
            task = np.zeros(len(sign_), np.int32)
            if len(hot) and (many := np.isin(sign_, hot)).any():
                task[many] = 1 + (wordhash.mix(id_[many].view(np.uint64)) % np.uint64(HOT_TASKS)).astype(np.int32)
            yield pd.DataFrame({"sign": sign_, "task": task, "id": id_})

    return sign


def _keep_chosen(n: int):
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[[set_key(shingles(t, n))[0] == lo for t, lo in zip(batch["text"], batch["of_lo"], strict=True)], ["id", "text"]]

    return keep


def _elements(n: int):
    def elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "elements": [shingles(t, n).view(np.int64) for t in batch["text"]]})

    return elements


def components(vertices: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, label): per vertex the smallest id it reaches over ``links(a, b)``.

    Every round each vertex takes the smallest label among its neighbours' and its own, then the label of that
    label, so distances shrink fast. Rounds go on until no label changes; each is written to shared storage."""
    both = scratch.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels, round_ = scratch.keep(vertices.select("id", F.col("id").alias("label")).distinct(), "labels0"), 0
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, F.col("id") == F.col("a"), "left").select("id", F.col("label").alias("was"), F.least("label", F.coalesce("near", "label")).alias("to"))
        # a label is an id of the same component: follow it
        jump = labels.select(F.col("id").alias("at"), F.col("label").alias("then"))
        new = hooked.join(jump, F.col("to") == F.col("at"), "left").select("id", "was", F.least("to", F.coalesce("then", "to")).alias("label"))
        round_ += 1
        new = scratch.keep(new, f"labels{round_}")
        scratch.drop(f"labels{round_ - 1}")
        labels = new.select("id", "label")
        if new.where("label <> was").isEmpty():
            scratch.drop("links")
            return labels


def _may_be_similar(percent: int):
    """Pairs whose sketches differ in no more cells than the sets may in elements."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["size"].to_numpy(), batch["other_size"].to_numpy()
            most = (100 - percent) * (sizes[0] + sizes[1]) // (100 + percent)
            cells = np.minimum(batch["sketch"].map(len), batch["other_sketch"].map(len)).to_numpy()
            near = np.zeros(len(batch), bool)
            for size in np.unique(cells):
                at = np.flatnonzero(cells == size)
                x, y = (_same_cells(batch[c].iloc[at].tolist(), int(size)) for c in ("sketch", "other_sketch"))
                near[at] = np.bitwise_count(x ^ y).sum(axis=1) <= most[at]
            yield batch.loc[near, ["a", "b"]]

    return check


def _similar(pairs: DataFrame, classes: DataFrame, known: DataFrame, n: int, percent: int, scratch: Scratch, into: str) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough. Sketches, which never hide a similar pair, are compared first;
    elements are made of the texts of those classes alone that are left, and move for those pairs."""
    left = classes.select(F.col("class").alias("a"), "size", "sketch")
    right = classes.select(F.col("class").alias("b"), F.col("size").alias("other_size"), F.col("sketch").alias("other_sketch"))
    met = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    near = scratch.keep(met.mapInPandas(_may_be_similar(percent), "a long, b long"), "near")
    wanted = scratch.keep(near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct(), "wanted")
    sets = known.join(wanted, "id", "left_semi").mapInPandas(_elements(n), "id long, elements array<long>")
    sets = scratch.keep(sets.dropDuplicates(["id"]), "elements")
    left = sets.select(F.col("id").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("elements").alias("y"))
    inner = F.size(F.array_intersect("x", "y"))
    found = near.join(left, "a").join(right, "b").select("a", "b", (F.size("x") + F.size("y")).alias("both"), inner.alias("inner"))
    links = scratch.keep(found.where(100 * F.col("inner") >= percent * (F.col("both") - F.col("inner"))).select("a", "b"), into)
    scratch.drop("near", "wanted", "elements")
    return links


def _open_pairs(labelled: DataFrame, classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of one signature but different components that sizes and sketches allow.

    A group is dealt to blocks of about BLOCK members; a row is a pair of blocks, compared in arrays, so the pairs of
    a group are never rows. Only pairs that may be similar come out."""
    counts = labelled.groupBy(F.col("sign").alias("in")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = labelled.join(counts.hint("merge"), F.col("sign") == F.col("in")).join(classes.select(F.col("class").alias("id"), "sketch").hint("merge"), F.col("class") == F.col("id"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
    member = F.collect_list(F.struct("class", "size", "label", "sketch")).alias("members")
    blocks = dealt.groupBy("sign", "blocks", "block").agg(member)
    names = {"class": "classes", "size": "sizes", "label": "labels", "sketch": "sketches"}

    def arrays(prefix: str) -> list[Column]:
        return [F.col("members")[f].alias(prefix + as_) for f, as_ in names.items()]

    blocks = scratch.keep(blocks, "blocks")
    alone = blocks.where("blocks = 1").select(*arrays(""), *arrays("other_")).mapInPandas(_compare(percent), "a long, b long")
    blocks = blocks.where("blocks > 1")
    left = blocks.select("sign", F.explode(F.sequence("block", F.col("blocks") - 1)).alias("to"), *arrays(""))
    right = blocks.select(F.col("sign").alias("other_sign"), F.col("block").alias("other"), *arrays("other_"))
    pairs = left.join(right.hint("merge"), (F.col("sign") == F.col("other_sign")) & (F.col("to") == F.col("other"))).drop("sign", "to", "other_sign", "other")
    return alone.unionByName(pairs.mapInPandas(_compare(percent), "a long, b long")).distinct()


def _sizes_fit(x: Column, y: Column, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85, cells: int = CELLS) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable over links, its own included).

    A set holds the distinct runs of ``n`` words of a whole text, A-Z lower-cased (all words, if fewer); null and
    empty texts have empty sets, linked with nothing. Two sets link when 100 * intersection >= percent * union. Ids are
    whole numbers; of several rows of one id the one with the smallest set key speaks for all; a null id is linked with
    nothing and its component is null.

    1. Every set is described by size and 128 bits; equal sets are one class from here on, told by a count with
    partial sums. 2. Every set signs (see Bands); two similar sets share a signature. Signatures shared by very many,
    found on a sample of documents, are dealt over several tasks. 3. Classes that share a signature with another are
    candidates: each is compared with the smallest and the largest class of its group, sizes before elements, and
    the links' components are found. 4. In groups whose members are still in several components, members of
    different components are compared block by block on bit sketches that never hide a similar pair; what passes is
    compared by elements, so no link between components is lost. Comparisons are made between plain scans, which
    adaptive execution splits; no task holds more than two blocks of a group, and pairs are rows only where they may
    be similar.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = rows.where("id IS NOT NULL")
    scratch = Scratch(docs.sparkSession, "op6")
    described = scratch.keep(rows.select("id", _describe(n)("text").alias("s")).select("id", "s.*"), "sets")
    own = described.where("id IS NOT NULL AND size > 0").groupBy("id").agg(F.min(F.struct("lo", "hi", "size", "sketch")).alias("set"), F.max("lo").alias("other"))
    own = scratch.keep(own.select("id", "set.*", (F.col("other") != F.col("set.lo")).alias("several")), "own")
    if not own.where("several").isEmpty():  # ids with different texts: only the chosen rows take part
        chosen = known.join(own.select(F.col("id").alias("of"), F.col("lo").alias("of_lo")), F.col("id") == F.col("of")).select("id", "text", "of_lo")
        known = scratch.keep(chosen.mapInPandas(_keep_chosen(n), "id long, text string"), "rows")
    classes = scratch.keep(own.groupBy("lo", "hi", "size").agg(F.min("id").alias("class"), F.min("sketch").alias("sketch")), "classes")
    member = scratch.keep(own.join(classes.drop("sketch"), ["lo", "hi", "size"]).select("id", "class", "size"), "members")

    schema = "sign long, task int, id long"
    total = member.count()
    sample = known if total <= HOT_SAMPLE else known.where(F.xxhash64("id", F.lit("hot")) < int(HOT_SAMPLE / total * 2**64) - 2**63)
    least = max(20, int(HOT_SHARE * min(total, HOT_SAMPLE)))
    seen = sample.mapInPandas(_sign(n, percent, cells, np.zeros(0, np.int64)), schema).groupBy("sign").agg(F.count("*").alias("times"))
    hot = np.array([r.sign for r in seen.where(F.col("times") >= least).select("sign").collect()], np.int64)

    # most signatures occur once and are of no use: their neighbours in the sorted task tell. Those of many tasks stay
    task = Window.partitionBy("sign", "task").orderBy("id")
    signed = known.mapInPandas(_sign(n, percent, cells, hot), schema).withColumn("before", F.lag("id").over(task)).withColumn("after", F.lead("id").over(task))
    shared = signed.where((F.col("before") != F.col("id")) | (F.col("after") != F.col("id")) | (F.col("task") > 0)).select("sign", "id")
    shared = scratch.keep(shared, "shared")
    groups = shared.join(member.select(F.col("id").alias("of"), "class", "size"), F.col("id") == F.col("of")).select("sign", "class", "size").distinct()
    groups = scratch.keep(groups, "groups")
    scratch.drop("shared")
    ends = groups.groupBy(F.col("sign").alias("in")).agg(F.min("class").alias("first"), F.max("class").alias("last"), F.min_by("size", "class").alias("first_size"), F.max_by("size", "class").alias("last_size"))
    ends = scratch.keep(ends.where("first < last"), "ends")
    groups = scratch.keep(groups.join(ends, F.col("sign") == F.col("in")).drop("in"), "mixed")
    scratch.drop("groups", "ends")

    to_first = groups.where(F.col("class") > F.col("first")).where(_sizes_fit(F.col("size"), F.col("first_size"), percent)).select(F.col("first").alias("a"), F.col("class").alias("b"))
    to_last = groups.where(F.col("class") < F.col("last")).where(_sizes_fit(F.col("size"), F.col("last_size"), percent)).select(F.col("class").alias("a"), F.col("last").alias("b"))
    tried = scratch.keep(to_first.unionByName(to_last).distinct(), "pairs")
    candidates = groups.select(F.col("class").alias("id")).distinct()
    links = _similar(tried, classes, known, n, percent, scratch, "similar")
    labels = components(candidates, links, scratch)

    labelled = groups.join(labels, F.col("class") == F.col("id")).select("sign", "class", "size", "label")
    open_ = labelled.groupBy(F.col("sign").alias("in")).agg(F.count("*").alias("n"), (F.min("label") < F.max("label")).alias("open"))
    open_ = open_.where(F.col("open") & (F.col("n") > 3)).select("in")  # with three classes or fewer all pairs were tried
    labelled = scratch.keep(labelled.join(open_, F.col("sign") == F.col("in"), "left_semi"), "open")
    rest = _open_pairs(labelled, classes, percent, scratch)
    rest = scratch.keep(rest.join(tried.hint("merge"), ["a", "b"], "left_anti"), "rest")
    scratch.drop("open", "blocks", "pairs")
    more = _similar(rest, classes, known, n, percent, scratch, "more")
    if not more.isEmpty():
        labels = components(candidates, links.unionByName(more), scratch)

    final = member.join(labels.select(F.col("id").alias("at"), "label"), F.col("class") == F.col("at"), "left").select(F.col("id").alias("of"), F.coalesce("label", "class").alias("component"))
    final = scratch.keep(final, "components")
    scratch.drop("own", "rows", "classes", "members", "mixed", "similar", "more", "rest", "labels*")
    return described.join(final, F.col("id") == F.col("of"), "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
