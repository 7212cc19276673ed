"""Benchmark decontamination: one Aho-Corasick automaton over the items' word windows, texts scanned once."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

#: Bytes that part words; every other byte, all of UTF-8's lead and tail bytes among them, is part of a word.
_SEPARATORS = [b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)]
_TABLE = bytes(0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RESULT = "n_words long, n_hit long, spans array<struct<item_id: string, first: long, last: long>>"


def normalise(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def windows(words: list[bytes], size: int) -> set[bytes]:
    """The windows of an item: every run of ``size`` words, or all words of a shorter item."""
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def _ordered(items: set[str | None]) -> list[str | None]:
    """Item ids in order, null last: an item without id has windows like any other."""
    return sorted(items, key=lambda i: (i is None, i or ""))


def pattern_slices(benchmark: DataFrame, size: int, max_bytes: int, id_col: str, text_col: str) -> Iterator[dict[bytes, set[str | None]]]:
    """Windows of the benchmark's items with the items they come from, in slices of about ``max_bytes`` of windows."""
    slice_, held = defaultdict(set), 0
    for item, text in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).toLocalIterator():
        if not (words := normalise(text)):
            continue
        for window in windows(words, size):
            slice_[window].add(item)
            held += len(window)
        if held >= max_bytes:
            yield dict(slice_)
            slice_, held = defaultdict(set), 0
    if slice_:
        yield dict(slice_)


class Scanner:
    """The automaton of one slice. Built once per Python worker."""

    def __init__(self, patterns: dict[bytes, set[str | None]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for window, items in patterns.items():
            # latin-1 gives one character a byte, so offsets are byte offsets; blanks at both ends keep to whole words
            self.automaton.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, _ordered(items)))
        if patterns:
            self.automaton.make_automaton()
        self.empty = not patterns

    def spans(self, words: list[bytes]) -> list[tuple[str, int, int]]:
        """(item, first word, last word) of every occurrence, from one pass over the words."""
        if self.empty or not words:
            return []
        line = f" {b' '.join(words).decode('latin-1')} "
        if not (found := list(self.automaton.iter(line))):
            return []
        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
        last = np.searchsorted(blanks, [end for end, _ in found]) - 1
        return [(item, int(at) - n + 1, int(at)) for at, (_, (n, items)) in zip(last, found, strict=True) for item in items]


def covered(spans, n_words: int) -> np.ndarray:
    """Which words lie in some span."""
    edges = np.zeros(n_words + 1, np.int64)
    for span in spans:
        edges[span["first"]] += 1
        edges[span["last"] + 1] -= 1
    return np.cumsum(edges)[:n_words] > 0


_scanners: dict[str, Scanner] = {}


def _scan(patterns: dict[bytes, set[str | None]], first: bool):
    key = hashlib.sha256(repr(sorted((k, _ordered(v)) for k, v in patterns.items())).encode()).hexdigest()

    def scan(text: str | None, before) -> tuple[int, int, list[dict]]:
        if key not in _scanners:
            _scanners.clear()
            _scanners[key] = Scanner(patterns)
        words = normalise(text)
        spans = [{"item_id": i, "first": a, "last": b} for i, a, b in _scanners[key].spans(words)]
        if before is not None and len(before):
            spans += [dict(s.asDict() if hasattr(s, "asDict") else s) for s in before]
        return len(words), int(covered(spans, len(words)).sum()) if spans else 0, spans

    if first:

        @F.pandas_udf(RESULT)
        def start(text: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([scan(t, None) for t in text], columns=["n_words", "n_hit", "spans"])

        return start

    @F.pandas_udf(RESULT)
    def further(text: pd.Series, before: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scan(t, b) for t, b in zip(text, before, strict=True)], columns=["n_words", "n_hit", "spans"])

    return further


def find_windows(docs: DataFrame, benchmark: DataFrame, size: int = 13, max_bytes: int = 64_000_000, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", into: str = "found") -> DataFrame:
    """``docs`` with one more column ``into``: struct(n_words, n_hit, spans(item_id, first, last)).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; a window is ``size`` consecutive words
    of an item, or a whole shorter item. ``spans`` lists every occurrence by its first and last word, ``n_hit`` counts
    the words inside any; ``word_offsets`` maps word numbers to offsets of the original text. No shuffle: every text is
    scanned where it is read, whole, in one pass of one automaton. The automaton is sent with the task; a benchmark whose
    windows take more than ``max_bytes`` is cut into several of that size, each of which scans the texts once more, after
    what was found before is written down: the driver holds two slices at a time, however many there are.
    Null and empty texts have no words; null and empty items no window; an empty benchmark hits nothing. Items without id
    count as one item of that (null) id. A column ``into`` that ``docs`` has is replaced: name another one to keep it.
    """
    slices = pattern_slices(benchmark, size, max_bytes, item_id, item_text)
    patterns, first = next(slices, {}), True
    while True:
        scan = _scan(patterns, first)
        args = [F.col(text_col).cast("string")] + ([] if first else [F.col(into)["spans"]])
        docs = docs.withColumn(into, scan(*args))
        patterns, first = next(slices, None), False
        if patterns is None:
            return docs
        docs = materialise(docs, "op7-slice")


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Start and end of every word in the original text, in characters."""
    return [m.span() for m in WORD.finditer(text)]


def is_contaminated(found: Column) -> Column:
    """At least one hit word, and at least one word in twenty hit."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per document: id, n_words, n_hit, item_ids (sorted, of items with occurring windows), contaminated."""
    found = find_windows(docs.select(F.col(id_col), F.col(text_col)), benchmark, text_col=text_col, **kw)
    f = F.col("found")
    items = F.array_sort(F.array_distinct(F.transform(f["spans"], lambda s: s["item_id"])))
    return found.select(F.col(id_col), f["n_words"].alias("n_words"), f["n_hit"].alias("n_hit"), items.alias("item_ids"), is_contaminated(f).alias("contaminated"))
