"""Ranked lexical search over a length-stratified index: documents of one length normaliser form a stratum, postings stand by
term frequency in it, and bounds of strata decide which are visited, and in which order."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import materialise

#: Terms of a stratum's part: larger strata are cut into parts of about so many, by a hash of the document.
PART_TERMS = 250_000
#: Pairs of item and term that travel with the tasks at once; more take several passes over the matched postings.
PASS_TERMS = 200_000
#: Parts an item visits first, for a score that many others cannot reach.
FIRST_PARTS = 16

_TERM = np.full(256, 0x20, np.uint8)
_TERM[0x30:0x3A] = np.arange(0x30, 0x3A)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)
_TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
_TERM[0x80:] = np.arange(0x80, 0x100)
_TERM = _TERM.tobytes()

INDEX = "m long, part long, term string, top int, df int, tfs array<int>, ends array<int>, docs array<int>, ids array<long>"


def terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters A-Z (lower-cased), a-z and code points from U+0080 on, in UTF-8."""
    return text.translate(_TERM).split()


@F.pandas_udf(T.LongType())
def _n_terms(text: pd.Series) -> pd.Series:
    return pd.Series([len(terms(t)) for t in text], dtype="int64")


def impact(tf, m: int):
    """What a term of weight 1 adds to a document's score."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _postings(m: int, part: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    """Rows of one part of a stratum: the first, without term, has the documents' ids in order; then one per term, with the
    documents' places by falling term frequency: ``ends[i]`` places have at least ``tfs[i]``."""
    numbers: dict[bytes, int] = {}
    term, doc, tf = [], [], []
    for d, text in enumerate(texts):
        found = Counter(terms(text))
        term += [numbers.setdefault(t, len(numbers)) for t in found]
        tf += found.values()
        doc += [d] * len(found)
    term, doc, tf = np.array(term, np.int64), np.array(doc, np.int32), np.array(tf, np.int32)
    order = np.lexsort((doc, -tf, term))
    term, doc, tf = term[order], doc[order], tf[order]
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    sizes = np.diff(np.r_[starts, len(term)])
    runs = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])
    run_ends = np.r_[runs[1:], len(term)] - np.repeat(starts, sizes)[runs]
    runs_of = np.searchsorted(runs, np.r_[starts, len(term)])
    runs_of[-1] = len(runs)
    n = len(starts) + 1

    def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, offsets].astype(np.int32)), pa.array(values.astype(np.int32)))

    names = [b"", *numbers]  # in the order of their numbers
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, m, np.int64)),
            pa.array(np.full(n, part, np.int64)),
            pa.array([t.decode(errors="replace") for t in names], pa.string()),
            pa.array(np.r_[0, tf[starts]].astype(np.int32)),
            pa.array(np.r_[0, sizes].astype(np.int32)),
            lists(tf[runs], runs_of),
            lists(run_ends, runs_of),
            lists(doc, np.r_[starts, len(term)]),
            pa.array([ids] + [None] * (n - 1), pa.list_(pa.int64())),
        ],
        ["m", "part", "term", "top", "df", "tfs", "ends", "docs", "ids"],
    )


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, int, list[list]]]:
    """Rows that are sorted by (m, part), one part at a time: m, part and these columns as lists."""
    at, held = None, [[] for _ in columns]
    for batch in batches:
        m, part = batch.column("m").to_numpy(), batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero((m[1:] != m[:-1]) | (part[1:] != part[:-1])) + 1), len(m)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if at != (m[a], part[a]):
                if at:
                    yield int(at[0]), int(at[1]), held
                at, held = (m[a], part[a]), [[] for _ in columns]
            for h, c in zip(held, columns, strict=True):
                piece = batch.column(c).slice(a, b - a)
                h += piece.to_pylist() if not pa.types.is_list(piece.type) else [piece[i].values for i in range(len(piece))]
    if at:
        yield int(at[0]), int(at[1]), held


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for m, part, (ids, texts) in _groups(batches, ["id", "text"]):
        yield _postings(m, part, ids, texts)


@dataclass(frozen=True)
class Index:
    """postings: one row per part of a stratum and term, see ``_postings``; documents with a term, and their terms."""

    postings: DataFrame
    docs: int
    terms: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_terms: int = PART_TERMS) -> Index:
    """The index of all documents that have a term, whole texts, every term.

    A document's normaliser m follows from its length n: 100 - 90 + (90 * n * N) div L, for N documents of L terms. Documents
    of one m are a stratum; strata are cut into parts of about ``part_terms``
    terms by a hash, so a part's texts bound what a task holds. Texts
    are dealt once, by part. Null texts have no terms; every row is a document, repeated rows too; ids may be null."""
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    lengths = materialise(picked.select(_n_terms("text").alias("n")).where("n > 0").groupBy("n").agg(F.count("*").alias("docs")), "op13-lengths")
    total = lengths.agg(F.sum("docs").alias("docs"), F.sum(F.col("n") * F.col("docs")).alias("terms")).first()
    if not total.docs:
        return Index(docs.sparkSession.createDataFrame([], INDEX), 0, 0)
    m = F.expr(f"10 + (90 * n * {total.docs}L) div {total.terms}L")
    strata = lengths.groupBy(m.alias("of")).agg(F.ceil(F.sum(F.col("n") * F.col("docs")) / part_terms).cast("long").alias("parts"))
    placed = picked.withColumn("n", _n_terms("text")).where("n > 0").withColumn("m", m).join(strata, F.col("m") == F.col("of"))
    placed = placed.select("m", F.pmod(F.xxhash64("id", "text"), "parts").alias("part"), "id", "text").repartition("m", "part")
    postings = placed.sortWithinPartitions("m", "part", F.col("id").asc_nulls_last()).mapInArrow(_build, INDEX)
    return Index(materialise(postings, "op13-index"), total.docs, total.terms)


class _Items:
    """Items of one pass: their terms with weights, and the score that a document has to reach."""

    def __init__(self, rows: list[tuple[object, list[tuple[str, int]]]], least: dict[int, int] | None = None):
        self.ids = [r[0] for r in rows]
        by_term: dict[str, list[tuple[int, int]]] = {}
        for i, (_, weighed) in enumerate(rows):
            for term, w in weighed:
                by_term.setdefault(term, []).append((i, w))
        self.by_term = {t: (np.array([x[0] for x in v], np.int64), np.array([x[1] for x in v], np.int64)) for t, v in by_term.items()}
        self.least = np.ones(len(rows), np.int64)  # a score has to be above 0
        for i, score in (least or {}).items():
            self.least[i] = max(1, score)

    def bounds(self, m: int, found: list[str], tops: list[int]) -> np.ndarray:
        """Per item the most that a document can score, by the highest term frequencies."""
        out = np.zeros(len(self.ids), np.int64)
        for term, top in zip(found, tops, strict=True):
            if term in self.by_term:
                items, weights = self.by_term[term]
                out[items] += weights * impact(top, m)
        return out


def _first_parts(items: _Items):
    """Per item of the pass the parts of highest bounds, among those of the task."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in items.ids]
        for m, part, (found, tops) in _groups(batches, ["term", "top"]):
            bounds = items.bounds(m, found, tops)
            for i in np.flatnonzero(bounds):
                push = heapq.heappush if len(best[i]) < FIRST_PARTS else heapq.heappushpop
                push(best[i], (int(bounds[i]), -m, -part))
        rows = [(i, b, -m, -p) for i, x in enumerate(best) for b, m, p in x]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], ["item", "bound", "m", "part"])

    return first


def _visits(items: _Items):
    """The parts where a document may reach the least score of some item, with the highest bound over such items."""

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for m, part, (found, tops) in _groups(batches, ["term", "top"]):
            bounds = items.bounds(m, found, tops)
            able = bounds >= items.least
            if able.any():
                rows.append((m, part, int(bounds[able].max())))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["m", "part", "bound"])

    return visits


def _score(items: _Items, k: int):
    """Postings sorted by (bound, m, part) -> per item the k best documents of the task."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, best = items.least.copy(), [[] for _ in items.ids]
        for m, part, (found, tops, tfs, ends, places, ids) in _groups(batches, ["term", "top", "tfs", "ends", "docs", "ids"]):
            able = items.bounds(m, found, tops) >= least
            if not able.any():
                continue
            names = next(x for x in ids if x is not None)
            adds: dict[int, list] = {}
            for term, tf, end, place in zip(found, tfs, ends, places, strict=True):
                if term not in items.by_term:
                    continue
                who, weights = items.by_term[term]
                who, weights = who[able[who]], weights[able[who]]
                if len(who):
                    of_run = impact(tf.to_numpy().astype(np.int64), m)  # once per term frequency
                    impacts, at = np.repeat(of_run, np.diff(end.to_numpy(), prepend=0)), place.to_numpy()
                    for i, w in zip(who.tolist(), weights.tolist(), strict=True):
                        adds.setdefault(i, []).append((at, w * impacts))
            for i, parts in adds.items():
                scores = np.zeros(len(names), np.int64)
                for at, more in parts:
                    scores[at] += more
                reach = np.flatnonzero(scores >= least[i])
                if len(reach) > k:
                    reach = reach[np.lexsort((reach, -scores[reach]))[:k]]
                for at in reach.tolist():
                    id_ = names[at].as_py()
                    best[i].append((-int(scores[at]), id_ is None, id_ or 0))
                best[i] = sorted(best[i])[:k]
                if len(best[i]) == k:
                    least[i] = max(least[i], -best[i][-1][0])
        rows = [(i, None if null else id_, -s) for i, x in enumerate(best) for s, null, id_ in x]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["item", "doc_id", "score"])

    return score


def _dealt(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Whole parts in one task each, one part after the other."""
    return rows.repartition("m", "part").sortWithinPartitions(*order, "m", "part", "term")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(id, term): the distinct terms of each item; rows of one id are one item."""
    kind = items.schema[id_col].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at)), pa.array([t.decode(errors="replace") for f in found for t in f], pa.string())], ["id", "term"])

    picked = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return picked.mapInArrow(split, f"id {kind}, term string").distinct()


def _pass(spark: SparkSession, matched: DataFrame, rows: list, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each of these items, item by its place in ``rows``."""
    items = _Items(rows)
    tops = _dealt(matched.select("m", "part", "term", "top"))
    bounds = tops.mapInArrow(_first_parts(items), "item long, bound long, m long, part long")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "part")
    first = bounds.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= FIRST_PARTS)
    parts = materialise(first.select("m", "part").distinct(), "op13-first")
    found = _dealt(matched.join(parts, ["m", "part"], "left_semi")).mapInArrow(_score(items, k), "item long, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    reached = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    items = _Items(rows, {r.item: r.score for r in reached.collect()})
    visits = materialise(tops.mapInArrow(_visits(items), "m long, part long, bound long"), "op13-visits")
    return _dealt(matched.join(visits, ["m", "part"]), F.desc("bound")).mapInArrow(_score(items, k), "item long, doc_id long, score long")


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 10, pass_terms: int = PASS_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k documents of highest score above 0, equal scores by ascending doc_id,
    null last.

    A document's score sums, over the item's distinct terms, weight * ((1000000000 * tf) div (1000 * tf + 8 * m)); a
    term in df of N documents weighs floor(1000 * ln((2 * N + 2) / (2 * df + 1))). Items without terms that occur have
    no rows, and so have empty tables. Rows of one item id are one item; other columns are ignored.

    1. Postings of the items' terms are picked from the index. 2. A part's bound for an item takes each term at its highest
    frequency there. Each item visits the parts of its highest bounds first; its k-th score there is the least it has to
    find. 3. Parts with a bound that reaches some item's least score are visited, highest bounds first, and the least
    scores rise on the way; all others cannot hold a result. Impacts are computed once per term frequency of a part's
    term. A task holds one part of a stratum and k documents an item. Items travel with the tasks, ``pass_terms`` pairs
    of item and term at a time.
    """
    kind = items.schema[id_col].dataType.simpleString()
    schema = f"item_id {kind}, doc_id long, score long"
    spark = items.sparkSession
    wanted = materialise(item_terms(items, id_col, text_col), "op13-items")
    pairs = wanted.count()
    if not index.docs or not pairs:
        return spark.createDataFrame([], schema).withColumn("rank", F.lit(0)).select(F.col("item_id").alias(id_col), "rank", "doc_id", "score")
    # written, so that its size is known: Spark sends it to the tasks if it is small, instead of dealing out the whole index
    needed = materialise(wanted.select("term").distinct().unionByName(spark.sql("SELECT '' AS term")), "op13-needed")
    matched = materialise(index.postings.join(needed, "term", "left_semi"), "op13-matched")
    weight = F.floor(1000 * F.log(F.lit(2 * index.docs + 2).cast("double") / (2 * F.sum("df") + 1))).cast("long")
    weights = matched.where("term <> ''").groupBy("term").agg(weight.alias("w"))
    passes = -(-pairs // pass_terms)
    weighed = wanted.join(weights, "term").groupBy("id").agg(F.collect_list(F.struct("term", "w")).alias("weighed"))
    weighed = materialise(weighed.withColumn("pass", F.pmod(F.xxhash64("id"), F.lit(passes))), "op13-weighed")
    out = spark.createDataFrame([], schema)
    for p in range(passes):
        rows = [(r.id, [(t.term, t.w) for t in r.weighed]) for r in weighed.where(F.col("pass") == p).select("id", "weighed").collect()]
        if rows:
            names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], f"of long, item_id {kind}")
            found = _pass(spark, matched, rows, k).join(names, F.col("item") == F.col("of")).select("item_id", "doc_id", "score")
            out = out.unionByName(materialise(found, "op13-found") if passes > 1 else found)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("item_id").alias(id_col), "rank", "doc_id", "score")
