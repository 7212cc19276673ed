"""Toxicity by weak supervision: a label model over lexicon and pattern voters trains a linear classifier."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

WORDS = re.compile(r"\w+")
#: General insults, one voter each. Fixed values.
INSULTS = """ass asshole bastard bitch bullshit clown crap cretin damn degenerate disgusting dumb dumbass filth filthy fool
freak fuck garbage hate idiot idiotic imbecile kill loser lowlife moron moronic nasty parasite pathetic pig rat retard rubbish
scum scumbag shit sick slut stupid subhuman trash ugly vermin vile whore worthless""".split()
#: Letter-like signs that hide a word.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
DISGUISED = re.compile(r"[A-Za-z]+[013457@$!]+[A-Za-z][A-Za-z013457@$!]*")
YOU_ARE = re.compile(r"\byou(?:'re| are) an? \w+", re.I)
SHOUTED = re.compile(r"\b[A-Z]{4,}\b")
#: Votes.
ABSTAIN, CLEAN, TOXIC = -1, 0, 1
THRESHOLD = 0.3
#: Lengths of the word beginnings that can become voters.
SHORTEST, LONGEST = 4, 7


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


class Voters:
    """Lexicon voters, one per word or per beginning of words (written with a ``*``), and pattern voters; votes() gives
    one vote of each."""

    PATTERNS = ["pattern:disguised", "pattern:you are", "pattern:shouting", "lexicon:any", "lexicon:none"]

    def __init__(self, lexicon: list[str]):
        self.lexicon, self.index = lexicon, {w: i for i, w in enumerate(lexicon)}
        self.gate = {w.rstrip("*")[:SHORTEST] for w in lexicon}
        self.lengths = sorted({len(w) - 1 for w in lexicon if w.endswith("*")})

    def entries(self, word: str) -> list[int]:
        """The lexicon voters that a word makes fire."""
        if word[:SHORTEST] not in self.gate:
            return []
        found = [word, *(f"{word[:n]}*" for n in self.lengths if n <= len(word))]
        return [self.index[w] for w in found if w in self.index]

    @property
    def names(self) -> list[str]:
        return [f"word:{w}" for w in self.lexicon] + self.PATTERNS

    def facts(self, text: str | None) -> tuple[np.ndarray, int]:
        """Occurrences per lexicon word, then of the three patterns; and the number of words."""
        words, out = words_of(text), np.zeros(len(self.lexicon) + 3)
        gate = self.gate
        for w in words:
            if w[:SHORTEST] in gate:
                out[self.entries(w)] += 1
        if text:
            out[-3] = sum(bool(self.entries(w.lower().translate(DISGUISE))) for w in DISGUISED.findall(text))
            out[-2] = len(YOU_ARE.findall(text))
            out[-1] = len(SHOUTED.findall(text)) > 0.3 * len(words)
        return out, len(words)

    def votes(self, facts: np.ndarray) -> np.ndarray:
        """TOXIC where a word or pattern occurs, CLEAN from the voter that saw no word; others abstain."""
        hits = facts > 0
        some = bool(hits[: len(self.lexicon)].any())
        return np.array([*np.where(hits, TOXIC, ABSTAIN), TOXIC if some else ABSTAIN, ABSTAIN if some or hits[-3] else CLEAN], np.int8)


def fit_label_model(votes: np.ndarray, prior: float, anchors: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of TOXIC per row, accuracies, weights) of a generative model of the votes.

    Each voter fires, given the true label, with a probability of its own; expectation maximisation finds these from
    the votes, held near ``anchors`` (per voter: rows of each class it fired on among rows with a given label, as
    pseudo-counts). Voters that fire together beyond what the label explains are correlated: their correlation, within
    the label classes, divides their say, so that a voter repeating another adds little.
    """
    fired = votes != ABSTAIN
    p = np.zeros(0)
    for _ in range(rounds):
        if not len(p):  # first from the anchors alone
            rates = np.stack([(anchors[:, 0] + 0.01) / (anchors[:, 2] + 1), (anchors[:, 1] + 0.01) / (anchors[:, 3] + 1)], axis=1)
            pi, p, weights = prior, np.full(len(votes), -1.0), np.ones(votes.shape[1])
        else:
            rates, pi, weights = _maximise(fired, p, anchors)
        rates = np.clip(rates, 1e-6, 1 - 1e-6)
        on, off = np.log(rates[:, 1] / rates[:, 0]), np.log((1 - rates[:, 1]) / (1 - rates[:, 0]))
        logit = math.log(pi / (1 - pi)) + (np.where(fired, on, off) * weights).sum(axis=1)
        before, p = p, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(before - p).max(initial=0) < 1e-6:
            break
    return p, rates[:, 1] / rates.sum(axis=1), weights


def _maximise(fired: np.ndarray, p: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Firing rates per class, share of the toxic class, and weights that correlated voters share."""
    rates = np.stack([(fired.T @ (1 - p) + anchors[:, 0] + 0.01) / ((1 - p).sum() + anchors[:, 2] + 1), (fired.T @ p + anchors[:, 1] + 0.01) / (p.sum() + anchors[:, 3] + 1)], axis=1)
    rest = fired - np.outer(1 - p, rates[:, 0]) - np.outer(p, rates[:, 1])  # what the label does not explain
    rest -= rest.mean(axis=0)
    spread = np.sqrt((rest**2).sum(axis=0)) + 1e-9
    corr = np.abs(rest.T @ rest) / np.outer(spread, spread)
    corr[fired.sum(axis=0) < 5] = 0  # too rare to tell
    corr = np.minimum(corr, corr.T)
    np.fill_diagonal(corr, 1)
    return rates, float(np.clip(p.mean(), 1e-4, 1 - 1e-4)), 1 / np.where(corr > 0.3, corr, 0).sum(axis=1)


def features(facts: np.ndarray, n_lexicon: int) -> np.ndarray:
    """Presence per lexicon word and pattern, number of different hits, and of all hits: a long text hides none."""
    hits = facts[:n_lexicon]
    return np.concatenate([(facts > 0).astype(float), [min(5, (hits > 0).sum()), min(5, hits.sum())]])


def fit_classifier(x: np.ndarray, y: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by accelerated gradient descent; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    look, t = w, 1.0
    step = 1 / (0.25 * np.linalg.norm(x, 2) ** 2 / max(1, len(x)) + decay)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ look, -30, 30)))
        grad = x.T @ (p - y) / max(1, len(x)) + decay * look
        new, t_new = look - step * grad, (1 + math.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray
    accuracies: dict[str, float]


def _words_by_class(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = {w for w in words_of(text) if len(w) <= 40}
            counts.update((w, int(toxic)) for w in words)
            counts.update((w, int(toxic)) for w in {f"{w[:n]}*" for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)})
        yield pd.DataFrame([(w, n if t else 0, n) for (w, t), n in counts.items()], columns=["word", "toxic", "n"])


def choose_lexicon(marking: dict[str, int], most: int, misleading: set[str]) -> list[str]:
    """The fixed insults without the misleading ones, and ``most`` marking entries: of nested beginnings the longest
    that still has nearly all rows of the shortest; whole words only where no chosen beginning covers them."""
    kept: dict[str, str] = {}  # shortest beginning -> chosen one
    for entry in sorted((m for m in marking if m.endswith("*")), key=lambda m: (len(m), m)):
        root = next((r for r in kept if entry.startswith(r[:-1])), None)
        if root is None:
            kept[entry] = entry
        elif marking[entry] >= 0.95 * marking[root]:
            kept[root] = entry
    beginnings = sorted(kept.values(), key=lambda e: (-marking[e], e))
    words = [m for m in marking if not m.endswith("*") and not any(m.startswith(b[:-1]) for b in beginnings)]
    chosen = sorted([*beginnings, *words], key=lambda e: (-marking[e], e))[:most]
    return sorted({*chosen, *(w for w in INSULTS if w not in misleading)})


def _facts_of(voters: Voters):
    def facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [voters.facts(t) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "facts": [f.tolist() for f, _ in found]})

    return facts


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_docs: int = 12_000, max_lexicon: int = 200) -> Model:
    """Learns from the rows of ``labels`` whose crc32(id as text) mod 4 is not 2.

    ``sample_docs`` bounds the labelled rows, drawn by a hash of the id against one rate. Besides the fixed insults,
    words that mark label 1 in the learned rows become voters, ``max_lexicon`` at most. Spark counts the words by class
    and gathers the votes; the driver fits the label model on the sample's votes, a few numbers a row, and the
    classifier on the posteriors that come out. The labels themselves only choose the lexicon and anchor the voters'
    accuracies. Null labels are left out; the first of several labels of one id by value counts once.
    """
    lab = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(~held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("toxic"))
    n = lab.count()
    if n > sample_docs:
        lab = lab.where(F.xxhash64(F.col("id").cast("string"), F.lit("sample")) < int(sample_docs / n * 2**64) - 2**63)
    rows = materialise(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(lab, "id").select("text", "toxic"), "op10-rows")
    sums = rows.groupBy().agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = sums["n"], sums["toxic"] or 0
    words = rows.mapInPandas(_words_by_class, "word string, toxic long, n long").groupBy("word").agg(F.sum("toxic").alias("t"), F.sum("n").alias("n"))
    rate = min(0.5, (toxic + 1) / (n + 2))
    # so often, only in rows of label 1, by chance: one word in a million; and not a peculiarity of a few rows
    least = max(4, math.ceil(math.log(1e6) / -math.log(rate)), toxic // 50)
    marking = words.where((F.col("t") >= least) & (F.col("t") >= 0.9 * F.col("n"))).orderBy(F.desc("t"), "word").limit(10 * max_lexicon).collect()
    general = words.where(F.col("word").isin(INSULTS)).where("2 * t < n").collect()
    voters = Voters(choose_lexicon({r.word: r.t for r in marking}, max_lexicon, {r.word for r in general}))
    names = voters.names
    got = rows.mapInPandas(_facts_of(voters), "toxic long, facts array<double>").toPandas() if n else None
    if got is None or not toxic or toxic == n:
        return Model(voters, np.concatenate([2 * np.ones(len(voters.lexicon)), np.zeros(5), [-2.0]]), {})
    facts = np.array(got["facts"].tolist())
    votes = np.stack([voters.votes(f) for f in facts])
    y = got["toxic"].to_numpy()
    fired = votes != ABSTAIN
    anchors = np.stack([fired[y == 0].sum(axis=0), fired[y == 1].sum(axis=0), np.full(len(names), (y == 0).sum()), np.full(len(names), (y == 1).sum())], axis=1)
    posterior, accuracy, _ = fit_label_model(votes, toxic / n, anchors)
    x = np.stack([features(f, len(voters.lexicon)) for f in facts])
    return Model(voters, fit_classifier(x, posterior), dict(zip(names, accuracy.tolist(), strict=True)))


class Scorer:
    """Scores texts with the classifier's weights."""

    def __init__(self, model: Model):
        self.model, self.n_lexicon = model, len(model.voters.lexicon)

    def score(self, text: str | None) -> float:
        facts, _ = self.model.voters.facts(text)
        x = features(facts, self.n_lexicon)
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(x @ self.model.weights[:-1] + self.model.weights[-1]))))))


def scorer(model: Model):
    """A column function: text -> score. The model is a few hundred numbers."""

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        own = Scorer(model)
        return pd.Series([own.score(t) for t in text], dtype="float64")

    return scored


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **kw) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    Scores read the text alone. Null and empty texts score as a text in which no voter fires. A null id is not held
    out and never learned from. Whole texts are scored where they are read, without a shuffle; repeated rows each.
    """
    scored = scorer(fit(docs, labels, id_col, text_col, **kw))
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), scored(F.col(text_col).cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
