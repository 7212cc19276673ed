"""Language identification: words first, shorter and shorter character n-grams for words never seen."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

#: A word: letters and the marks on them.
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNDETERMINED = "und"
#: Longest n-gram tried, and the pseudo-count of unseen entries.
LONGEST, ALPHA = 4, 0.5


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked."""
    padded = f"<{word}>"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Model:
    """What is learned: known words and n-grams with a log frequency per language (bounded by ``fit``'s arguments)."""

    langs: list[str]
    entries: list[str] = field(default_factory=list)  # words, then n-grams
    n_words: int = 0
    logs: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


def _learned(docs: DataFrame, id_col: str, lang_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(lang_col).isNotNull() & (F.crc32(F.col(id_col).cast("string")) % 5 != 0)).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")).alias("draw"), F.col(text_col).cast("string").alias("text")
    )


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            for word, n in Counter(words_of(text)).items():
                counts[lang, word] += n
        yield pd.DataFrame([(lang, w, n) for (lang, w), n in counts.items()], columns=["lang", "entry", "n"])


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(batch["lang"], batch["entry"], batch["n"], strict=True):
            for size in range(1, LONGEST + 1):
                for gram in grams_of(word, size):
                    counts[lang, gram] += n
        yield pd.DataFrame([(lang, g, n) for (lang, g), n in counts.items()], columns=["lang", "entry", "n"])


def _top(counts: DataFrame, limit: int, least: int) -> tuple[list[str], dict[tuple[str, str], int]]:
    total = counts.groupBy("entry").agg(F.sum("n").alias("total")).where(F.col("total") >= least)
    chosen = total.orderBy(F.desc("total"), "entry").limit(limit)
    rows = counts.join(chosen.select("entry"), "entry", "left_semi").collect()
    return sorted({r.entry for r in rows}), {(r.lang, r.entry): r.n for r in rows}


def fit(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", sample_docs: int = 5000, max_words: int = 50_000, max_grams: int = 60_000) -> Model:
    """Learns from the documents whose crc32(id as text) mod 5 is not 0 and whose language is not null.

    ``sample_docs`` bounds the labelled rows: about so many are drawn, each by a hash of its id against one rate, whole
    texts. ``max_words`` and ``max_grams`` bound the model (the most frequent stay; a word must occur twice), which is
    all that reaches the driver and goes out with the tasks. Counts are summed by Spark, partial sums first. Rows
    without an id are left out (their remainder is null). No labelled row: a model without languages.
    """
    labelled = _learned(docs, id_col, lang_col, text_col)
    n = labelled.count()
    if n > sample_docs:
        bound = int(sample_docs / n * 2**64) - 2**63
        labelled = labelled.where(F.col("draw") < bound)
    schema = "lang string, entry string, n long"
    words = labelled.select("lang", "text").mapInPandas(_count_words, schema).groupBy("lang", "entry").agg(F.sum("n").alias("n"))
    words = materialise(words, "op3-words")
    grams = words.mapInPandas(_count_grams, schema).groupBy("lang", "entry").agg(F.sum("n").alias("n"))
    grams = materialise(grams, "op3-grams")
    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    known, word_n = _top(words, max_words, 2)
    kept, gram_n = _top(grams, max_grams, 1)
    gram_totals = Counter()
    for (lang, g), k in gram_n.items():
        gram_totals[lang, len(g)] += k
    sizes = Counter(len(g) for g in kept)
    logs = np.zeros((len(known) + len(kept), len(langs)))
    for j, lang in enumerate(langs):
        for i, w in enumerate(known):
            logs[i, j] = (word_n.get((lang, w), 0) + ALPHA) / (totals[lang] + ALPHA * len(known))
        for i, g in enumerate(kept, len(known)):
            logs[i, j] = (gram_n.get((lang, g), 0) + ALPHA) / (gram_totals[lang, len(g)] + ALPHA * sizes[len(g)])
    logs = np.log(logs)
    return Model(langs, [*known, *kept], len(known), logs)


class Identifier:
    """Scores texts with a model. Vectors of unseen words are kept in a table of bounded size."""

    SLICE = 50_000

    def __init__(self, model: Model):
        self.langs, self.n_words = model.langs, model.n_words
        self.words = {w: i for i, w in enumerate(model.entries[: model.n_words])}
        self.grams = {g: i for i, g in enumerate(model.entries[model.n_words :])}
        self.gram_logs = model.logs[model.n_words :]
        self.room = max(2 * self.SLICE, 4_000_000 // max(1, len(self.langs)) // 8)
        self.table = np.zeros((model.n_words + self.room, max(1, len(self.langs))))
        if self.langs:
            self.table[: model.n_words] = model.logs[: model.n_words]
        self._forget()

    def _forget(self) -> None:
        self.known, self.free = dict(self.words), self.n_words

    def back_off(self, word: str) -> np.ndarray:
        """Mean log frequency of the word's n-grams, of the longest size of which any is known."""
        for n in range(LONGEST, 0, -1):
            found = [self.grams[g] for g in grams_of(word, n) if g in self.grams]
            if found:
                return self.gram_logs[found].sum(axis=0) / len(found)
        return np.zeros(len(self.langs))

    def _index(self, word: str) -> int:
        i = self.known.get(word)
        if i is None:
            i = self.known[word] = self.free
            self.table[i] = self.back_off(word)
            self.free += 1
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        total = np.zeros(len(self.langs))
        for k in range(0, len(words), self.SLICE):
            part = words[k : k + self.SLICE]
            if self.free + len(part) > len(self.table):
                self._forget()
            total += self.table[np.fromiter(map(self._index, part), np.int64, len(part))].sum(axis=0)
        share = np.exp((total - total.max()) / np.sqrt(len(words)))
        best = int(share.argmax())
        return self.langs[best], float(share[best] / share.sum())


_identifiers: dict[str, Identifier] = {}


def predictor(model: Model):
    """A column function: text -> struct(lang_pred, score). One identifier per Python worker and model."""
    import uuid

    key = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predicted(text: pd.Series) -> pd.DataFrame:
        if key not in _identifiers:
            _identifiers.clear()
            _identifiers[key] = Identifier(model)
        return pd.DataFrame([_identifiers[key].predict(t) for t in text], columns=["lang_pred", "score"])

    return predicted


def has_letter(text: Column) -> Column:
    @F.pandas_udf("boolean")
    def found(text: pd.Series) -> pd.Series:
        return pd.Series([bool(words_of(t)) for t in text], dtype=bool)

    return found(text)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def identify_language(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", **kw) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score (the share of the best language, 0 to 1).

    Prediction reads the text alone. A text that is null or has no letter is ``und`` with score 0, as is every text
    when nothing could be learned; equal scores go to the smaller language code. A null id is not held out, and not
    learned from. Whole texts are scored where they are read, without a shuffle; repeated rows are scored each.
    """
    predicted = predictor(fit(docs, id_col, lang_col, text_col, **kw))
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), predicted(F.col(text_col).cast("string")).alias("found"))
    return rows.select(id_col, "held_out", "found.lang_pred", "found.score")
