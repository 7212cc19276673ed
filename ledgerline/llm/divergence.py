"""Source divergence audit: how the vocabulary of each source differs from that of the others of its language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

#: Cells (term and source) a task holds before it hands its stripes on.
CELLS = 300_000
#: Sums (pairs of sources) a task holds before it hands them on.
SUMS = 4_000_000
#: Rows of the matrices that a task works on at once: about so many numbers.
PIECE = 1_000_000
#: Parts of a probability, and what is added to every count.
PARTS, SMOOTH = 1_000_000_000, 5

_TERM = np.full(256, 0x20, np.uint8)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)
_TERM[0x61:0x7B] = np.arange(0x61, 0x7B)
_TERM[0x80:] = np.arange(0x80, 0x100)
_TERM = _TERM.tobytes()


def terms(text: bytes) -> list[bytes]:
    """Runs of letters A-Z (lower-cased), a-z and code points from U+0080 on, in UTF-8."""
    return text.translate(_TERM).split()


def _stripes(most: int):
    """Folds whole documents (lang, source, text) into stripes: per language and source, term -> occurrences and term -> documents,
    handed on as (lang, term) with source -> [documents, occurrences]; ``most`` cells are handed on and begun anew."""

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, tuple[Counter, Counter]]] = {}
        cells = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                found = terms(text)
                if not found:
                    continue
                cell = held.setdefault(lang, {}).setdefault(source, (Counter(), Counter()))
                before = len(cell[0])
                cell[0].update(found)
                cell[1].update(set(found))
                cells += len(cell[0]) - before
                if cells >= most:
                    yield from _handed_on(held)
                    held, cells = {}, 0
        yield from _handed_on(held)

    return stripes


def _handed_on(held: dict[str, dict[str, tuple[Counter, Counter]]]) -> Iterator[pa.RecordBatch]:
    for lang, sources in held.items():
        found = pa.array([t for n, _ in sources.values() for t in n], pa.binary()).dictionary_encode()
        at = found.indices.to_numpy()
        order = np.argsort(at, kind="stable")  # cells by term
        sizes = [len(n) for n, _ in sources.values()]
        names = pa.array(list(sources), pa.string()).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)[order]))
        occurrences = np.fromiter((k for n, _ in sources.values() for k in n.values()), np.int64, len(at))
        documents = np.fromiter((k for n, docs in sources.values() for k in map(docs.__getitem__, n)), np.int64, len(at))
        cell = pa.StructArray.from_arrays([names, pa.array(documents[order]), pa.array(occurrences[order])], ["source", "docs", "n"])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(found.dictionary)))])
        try:
            words = found.dictionary.cast(pa.string())
        except pa.ArrowInvalid:  # not all of it is UTF-8
            words = pa.array([t.decode(errors="replace") for t in found.dictionary.to_pylist()], pa.string())
        for k in range(0, len(words), 20_000):
            bounds = offsets[k : k + 20_001]
            stripe = pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()), cell.slice(bounds[0], bounds[-1] - bounds[0]))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(stripe), pa.string()), words.slice(k, 20_000), stripe], ["lang", "term", "stripe"])


def probability(counts: np.ndarray, total, kept: int) -> np.ndarray:
    """1 + floor(PARTS * (count + SMOOTH) / (total + SMOOTH * kept)), exact in 64-bit integers for totals below 9 * 10**15:
    the division goes on digit by digit, three digits at a time."""
    whole, rest = np.divmod(counts + SMOOTH, total + SMOOTH * kept)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total + SMOOTH * kept)
        whole = whole * 1000 + step
    return whole + 1


class _Sources:
    """The sources of one language, in order, with their occurrences of kept terms, and the number of kept terms."""

    def __init__(self, rows: list[tuple[str, int]], kept: int):
        rows = sorted(rows)
        self.names, self.kept = [r[0] for r in rows], kept
        self.totals = np.array([r[1] for r in rows], np.int64)
        self.at = {n: i for i, n in enumerate(self.names)}
        self.zero = probability(np.zeros(len(rows), np.int64), self.totals, kept)


def _diverge(languages: dict[str, _Sources], top: int):
    """Merged stripes (lang, term, sources, counts) -> partial sums of |p - q| for pairs of sources, and each source's ``top``
    terms above its language, among the stripes of the task. A task holds the sums of SUMS pairs at most."""
    schema = ["lang", "source", "part", "item", "value"]

    def frame(lang: str, part: str, source: list[str], item: list[str], value: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"lang": lang, "source": source, "part": part, "item": item, "value": value}, columns=schema)

    def sums_of(lang: str, sums: np.ndarray) -> Iterator[pd.DataFrame]:
        names = languages[lang].names
        for a in range(len(names) - 1):
            yield frame(lang, "pair", [names[a]] * (len(names) - a - 1), names[a + 1 :], sums[a, a + 1 :])

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lang", "source", "value", "item"], ascending=[True, True, False, True])
        return rows.groupby(["lang", "source"], sort=False).head(top)

    def diverge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        ranked = None
        for batch in batches:
            found = [ranked] if ranked is not None else []
            for lang, rows in batch.groupby("lang", sort=False):
                known = languages[lang]
                width = len(known.names)
                if lang not in sums:
                    if sum(s.size for s in sums.values()) + width * width > SUMS:
                        for other in list(sums):
                            yield from sums_of(other, sums.pop(other))
                    sums[lang] = np.zeros((width, width), np.int64)
                step = max(1, PIECE // width)
                for k in range(0, len(rows), step):
                    part = rows.iloc[k : k + step]
                    lengths = part["sources"].map(len).to_numpy()
                    row = np.repeat(np.arange(len(part)), lengths)
                    column = np.array([known.at[s] for r in part["sources"] for s in r], np.int64)
                    counts = np.concatenate(part["counts"].to_list()).astype(np.int64)
                    p = np.broadcast_to(known.zero, (len(part), width)).copy()
                    p[row, column] = probability(counts, known.totals[column], known.kept)
                    for a in range(width - 1):
                        sums[lang][a, a + 1 :] += np.abs(p[:, a + 1 :] - p[:, a : a + 1]).sum(axis=0)
                    q = probability(np.bincount(row, counts, len(part)).astype(np.int64), known.totals.sum(), known.kept)
                    over = p[row, column] - q[row]
                    more = np.flatnonzero(over > 0)
                    items = part["term"].to_numpy()[row[more]]
                    found.append(frame(lang, "term", [known.names[c] for c in column[more]], items, over[more]))
            ranked = best(pd.concat(found)) if found else ranked
        for lang, held in sums.items():
            yield from sums_of(lang, held)
        if ranked is not None:
            yield ranked

    return diverge


def merged_stripes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 30, cells: int = CELLS) -> DataFrame:
    """Per (lang, term) in at least ``least_docs`` documents of the language: lang, term, docs, sources array<string>, counts
    array<long> (occurrences in each of these sources). Null columns count as empty.

    Tasks fold documents into stripes and hand on ``cells`` cells at a time; stripes meet by (lang, term), so a frequent
    term costs a row per task and spill, whatever the sizes of its sources."""
    picked = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    folded = picked.mapInArrow(_stripes(cells), "lang string, term string, stripe array<struct<source string, docs long, n long>>")
    merged = folded.repartition("lang", "term").select("lang", "term", F.explode("stripe").alias("c")).select("lang", "term", "c.*")
    merged = merged.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))  # on the same partitions
    stripes = merged.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("stripe")).where(F.col("docs") >= least_docs)
    return stripes.select("lang", "term", "docs", F.col("stripe.source").alias("sources"), F.col("stripe.n").alias("counts"))


def audit_sources(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 30, top: int = 50, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: the distance of the source to each other source of the language,
    the sum over the language's kept terms of the difference of both smoothed probabilities (in 10**-9 parts). Part
    ``term``: the ``top`` terms that stand out of the language most in the source. Ranks from 1, by falling value, then item.

    Null text, lang and source count as empty; every row is a document, repeated rows too. A group without terms has
    its pairs all the same; a language without kept terms has distances of 0 and no terms; a language of one source
    has no pairs. Other columns are ignored, whatever their names. An empty table gives an empty table.

    1. Tasks fold documents into stripes, which are merged by term (merged_stripes). 2. Merged stripes give divergences
    at once: a task adds up the differences of all pairs of sources over its stripes, and keeps its best terms of each
    source. 3. Those partial sums and terms are added up and ranked. The driver holds one number per (lang, source); the
    result has a row for each pair of those.
    """
    spark = docs.sparkSession
    stripes = materialise(merged_stripes(docs, text_col, lang_col, source_col, least_docs, cells), "op12-stripes")
    names = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))))
    groups = names.distinct()
    counted = stripes.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("total"))
    kept = {r.lang: r.kept for r in stripes.groupBy("lang").agg(F.count("*").alias("kept")).collect()}
    by_lang: dict[str, list[tuple[str, int]]] = {}
    for r in groups.join(counted, ["lang", "source"], "left").collect():
        by_lang.setdefault(r.lang, []).append((r.source, r.total or 0))
    languages = {lang: _Sources(rows, kept.get(lang, 0)) for lang, rows in by_lang.items() if kept.get(lang)}

    found = stripes.select("lang", "term", "sources", "counts").mapInPandas(_diverge(languages, top), "lang string, source string, part string, item string, value long")
    found = materialise(found, "op12-partial")
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = spark.createDataFrame([(lang, s) for lang, rows in by_lang.items() if not kept.get(lang) for s, _ in rows], "lang string, source string")
    zero = bare.join(bare.select(F.col("lang").alias("of"), F.col("source").alias("item")), (F.col("lang") == F.col("of")) & (F.col("source") < F.col("item"))).drop("of")
    sums = sums.unionByName(zero.withColumn("value", F.lit(0).cast("long")))
    pairs = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    over = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(over.select(columns))
