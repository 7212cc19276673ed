"""Substring duplicates by super-k-mer partitioning: windows that share a minimiser travel as one packed string."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import wordhash
from ledgerline.llm.common import materialise

#: Words of a minimiser.
MINIMISER = 5
#: Packed strings that one bucket takes at most; a larger bucket is dealt out to several, whose counts are added.
BUCKET = 4096


def super_kmers(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, content, first window, number of windows) of the runs of windows with the same minimiser.

    A window's minimiser is the leftmost smallest hash of ``MINIMISER`` consecutive words in it. Runs go by its
    place, so two equal windows are never in one run. Content is a hash of all the run's words.
    """
    size = min(MINIMISER, window)
    value = wordhash.gram_hashes(hashes, size)
    wide = window - size + 1
    if len(value) < wide:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at = np.arange(len(value))
    reach = 1
    while reach < wide:  # smallest of the next `reach` hashes, doubling
        step = min(reach, wide - reach)
        left, right = value[:-step], value[step:]
        at = np.where(left <= right, at[:-step], at[step:])
        value = np.minimum(left, right)
        reach += step
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(first, len(at)))
    content = wordhash.range_hashes(hashes, first, first + count + window - 1)
    return value[first].view(np.int64), content.view(np.int64), first, count


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _features(window: int):
    @F.pandas_udf("n_words long, sha string, mini array<long>, content array<long>, first array<int>, n array<int>")
    def features(text: pd.Series) -> pd.DataFrame:
        out = []
        for t in text:
            data = wordhash.encode(t)
            words = data.tobytes().split()
            mini, content, first, count = super_kmers(wordhash.word_hashes(data), window) if len(words) >= window else ([], [], [], [])
            out.append((len(words), _digest(words), mini, content, first, count))
        return pd.DataFrame(out, columns=["n_words", "sha", "mini", "content", "first", "n"])

    return features


def _pack(window: int):
    """The packed strings of the chosen runs of each text. Runs come as one array per field."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            fields = ["mini", "salt", "salts", "content", "times", "first", "n"]
            for text, *runs in zip(batch["text"], *(batch[f] for f in fields), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                out += [(*run, b" ".join(words[first : first + n + window - 1])) for *run, first, n in zip(*runs, strict=True)]
            yield pd.DataFrame(out, columns=["mini", "salt", "salts", "content", "times", "packed"])

    return pack


def _runs(offsets: list[int]) -> list[dict[str, int]]:
    """Consecutive window offsets as ranges of windows."""
    out: list[dict[str, int]] = []
    for o in offsets:
        if out and out[-1]["last"] == o - 1:
            out[-1]["last"] = o
        else:
            out.append({"first": o, "last": o})
    return out


def _count(window: int):
    """Sorts the windows of each bucket and counts them. Rows come sorted by bucket; a bucket has at most BUCKET strings.

    A bucket that is alone for its minimiser gives its strings' repeated windows; buckets that share a minimiser give
    every window with its count, for adding up."""

    def bucket(rows: pd.DataFrame) -> list[tuple]:
        windows = []
        for content, times, packed in zip(rows["content"], rows["times"], rows["packed"], strict=True):
            words = packed.split(b" ")
            windows += [(b" ".join(words[i : i + window]), content, i, times) for i in range(len(words) - window + 1)]
        windows.sort(key=lambda w: w[0])
        mini, alone = int(rows["mini"].iloc[0]), int(rows["salts"].iloc[0]) == 1
        found: dict[int, list[int]] = {}
        out = []
        for text, same in groupby(windows, key=lambda w: w[0]):
            same = list(same)
            total = sum(w[3] for w in same)
            if not alone:
                digest = hashlib.blake2b(text, digest_size=16).digest()
                out += [(mini, w[1], w[2], digest, total if k == 0 else 0, None) for k, w in enumerate(same)]
            elif total > 1:
                for w in same:
                    found.setdefault(w[1], []).append(w[2])
        return out + [(mini, content, None, None, None, _runs(sorted(o))) for content, o in found.items()]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None

        def emit(rows: pd.DataFrame) -> pd.DataFrame:
            out = [r for _, own in rows.groupby(["mini", "salt"], sort=False) for r in bucket(own)]
            frame = pd.DataFrame(out, columns=["mini", "content", "offset", "digest", "total", "runs"])
            return frame.astype({"offset": "Int32", "total": "Int64"})

        for batch in batches:
            if not len(batch):
                continue
            rows = batch if left is None else pd.concat([left, batch], ignore_index=True)
            last = (rows["mini"] == rows["mini"].iloc[-1]) & (rows["salt"] == rows["salt"].iloc[-1])
            left = rows[last]
            if not last.all():
                yield emit(rows[~last])
        if left is not None:
            yield emit(left)

    return count


def _field(name: str) -> Column:
    """One field of all runs, as an array."""
    return F.transform("runs", lambda r: r[name]).alias(name)


def _remove(window: int):
    @F.pandas_udf("n_removed long, sha string, spans array<struct<first: int, last: int>>")
    def remove(text: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
        out = []
        for t, first, last in zip(text, firsts, lasts, strict=True):
            words = (t or "").encode("utf-8", "surrogatepass").split()
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, first, 1)
            np.add.at(edges, last + window, -1)
            gone = np.cumsum(edges)[:-1] > 0
            change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
            spans = [{"first": int(a), "last": int(b) - 1} for a, b in zip(change[::2], change[1::2], strict=True)]
            out.append((int(gone.sum()), _digest([w for w, g in zip(words, gone, strict=True) if not g]), spans))
        return pd.DataFrame(out, columns=["n_removed", "sha", "spans"])

    return remove


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """One row per input row: id, n_words, n_removed, spans (removed words, first and last), kept_sha256.

    A window is ``window`` consecutive words of one document; every word in a window whose word sequence also starts
    anywhere else, the same document included, is removed. Windows are judged on the input. Null and empty texts and
    texts of fewer words have no window. Repeated rows of one id and text repeat each other. ``kept_text`` applies spans.

    1. Every text gives its super-k-mers: minimiser, content hash, place. Where a minimiser occurs once, no window
       under it repeats; those super-k-mers end here. 2. Equal super-k-mers are counted, so copies are one from here on;
       a content that occurs twice and is alone under its minimiser has all its windows twice. 3. One packed string of
       every other content travels to its minimiser's bucket, where windows are sorted and counted byte by byte.
       A bucket of more than BUCKET strings is dealt to several tasks by content, and their counts are added by the
       windows' 128-bit digests. 4. Repeated windows go back to the places of their content and on to the texts.
    Texts move twice, the second time only those with a repeated minimiser; all else is numbers. Nothing is collected
    per minimiser; a content or minimiser with a third of all rows is counted with partial sums and joined between
    plain scans, which adaptive execution splits.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.hash(F.col(text_col)).alias("fp"), F.col(text_col).cast("string").alias("text"))
    per_doc = materialise(rows.select("id", "fp", _features(window)("text").alias("f")).select("id", "fp", "f.*"), "op8-documents")

    places = per_doc.select("id", "fp", F.explode(F.arrays_zip("mini", "content", "first", "n")).alias("p")).select("id", "fp", "p.mini", "p.content", "p.first", "p.n")
    repeated = materialise(places.groupBy("mini").agg(F.count("*").alias("times")).where("times > 1").select(F.col("mini").alias("again")), "op8-minimisers")
    places = materialise(places.join(repeated.hint("merge"), F.col("mini") == F.col("again"), "left_semi"), "op8-places")

    contents = places.groupBy("mini", "content").agg(F.count("*").alias("times"), F.min(F.struct("id", "fp", "first", "n")).alias("at"))
    contents = materialise(contents, "op8-contents")
    buckets = contents.groupBy(F.col("mini").alias("of")).agg(F.count("*").alias("contents"))
    contents = contents.join(buckets.hint("merge"), F.col("mini") == F.col("of")).drop("of")
    alone = contents.where("contents = 1").select("mini", "content", F.expr("array(struct(0 as first, at.n - 1 as last))").cast("array<struct<first:int,last:int>>").alias("runs"))
    salts = F.ceil(F.col("contents") / BUCKET)
    chosen = contents.where("contents > 1").select(
        "at.id", "at.fp", F.struct("mini", F.pmod(F.xxhash64("content"), salts).alias("salt"), salts.alias("salts"), "content", "times", F.col("at.first").alias("first"), F.col("at.n").alias("n")).alias("run")
    )
    chosen = places.select("id", "fp", F.lit(None).cast(chosen.schema["run"].dataType).alias("run")).distinct().unionByName(chosen)
    chosen = chosen.groupBy(F.col("id").alias("of_id"), F.col("fp").alias("of_fp")).agg(F.collect_list("run").alias("runs"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("fp") == F.col("of_fp"))
    texts = materialise(rows.join(chosen.hint("merge"), same).select("id", "fp", "text", "runs"), "op8-texts")

    fields = [_field(f) for f in ("mini", "salt", "salts", "content", "times", "first", "n")]
    packed = texts.where(F.size("runs") > 0).select("text", *fields).mapInPandas(_pack(window), "mini long, salt long, salts long, content long, times long, packed binary")
    counted = (
        packed.repartition("mini", "salt")
        .sortWithinPartitions("mini", "salt")
        .mapInPandas(_count(window), "mini long, content long, offset int, digest binary, total long, runs array<struct<first:int,last:int>>")
    )
    counted = materialise(counted, "op8-counted")
    shared = counted.where("digest is not null")
    often = shared.groupBy(F.col("mini").alias("m"), F.col("digest").alias("d")).agg(F.sum("total").alias("total")).where("total > 1")
    across = shared.join(often, (F.col("mini") == F.col("m")) & (F.col("digest") == F.col("d")), "left_semi")
    across = across.groupBy("mini", "content").agg(F.collect_list(F.struct(F.col("offset").alias("first"), F.col("offset").alias("last"))).alias("runs"))
    found = alone.unionByName(counted.where("runs is not null").select("mini", "content", "runs")).unionByName(across)
    found = materialise(found.select(F.col("mini").alias("m"), F.col("content").alias("c"), "runs"), "op8-repeated")

    shift = F.transform("runs", lambda r: F.struct((F.col("first") + r["first"]).alias("first"), (F.col("first") + r["last"]).alias("last")))
    marked = places.join(found.hint("merge"), (F.col("mini") == F.col("m")) & (F.col("content") == F.col("c"))).select("id", "fp", shift.alias("runs"))
    marked = marked.distinct().groupBy(F.col("id").alias("of_id"), F.col("fp").alias("of_fp")).agg(F.flatten(F.collect_list("runs")).alias("runs"))
    texts = texts.select("id", "fp", "text").dropDuplicates(["id", "fp"])
    changed = texts.join(marked.hint("merge"), same).select("id", "fp", _remove(window)("text", _field("first"), _field("last")).alias("r"))
    changed = materialise(changed.select(F.col("id").alias("of_id"), F.col("fp").alias("of_fp"), "r.n_removed", F.col("r.sha").alias("new_sha"), "r.spans"), "op8-changed")
    spans = "array<struct<first:int,last:int>>"
    return (
        per_doc.select("id", "fp", "n_words", "sha")
        .join(changed.hint("merge"), same, "left")
        .select(
            F.col("id").alias(id_col),
            "n_words",
            F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("spans", F.array().cast(spans)).alias("spans"),
            F.coalesce("new_sha", "sha").alias("kept_sha256"),
        )
    )


def kept_text(text: str | None, spans) -> str:
    """A text without the words of ``spans``, its other words joined by one blank."""
    gone = {i for s in spans for i in range(s["first"], s["last"] + 1)}
    return b" ".join(w for i, w in enumerate((text or "").encode("utf-8", "surrogatepass").split()) if i not in gone).decode("utf-8", "surrogatepass")
