"""Chat formatting, source divergence and lexical search against brute-force versions on small tables with nulls, empty and
long texts, ties, repeated rows and extra columns; and on empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from ledgerline.llm import chat_format, divergence, lexical_search

DOCS = "doc_id long, text string, lang string, source string, term string, part string, stripe string, m long, n long, id string, rank int"


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return chat_format.Vocabulary(f.read(), public_tokenizers.PATTERN)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# -- 11 chat formatting

TALK = "conv_id long, turn long, role string, text string, ids string, mask string, grp long, place long"


def talk():
    t = chat_format.Template()
    rng = random.Random(3)
    odd = [*t.controls, "\\", "<\\s>", "<\\\\/s>", "[\\INST]", "<", "[", "é", "▁ ▁", "\n", "日本", "\0", " ", "s>", "<<SYS>", "SYS>>", "x" * 3000, "<|endoftext|>"]
    rows = []
    for conv in range(40):
        for turn in range(rng.choice([1, 2, 3, 8])):
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "</s>", "Assistant", "[ROLE]x[/ROLE]"])
            rows.append((conv, turn * rng.choice([1, 1, 40]), role, rng.choice(["", None, "".join(rng.choice(odd) for _ in range(rng.randint(1, 9)))])))
    rows += [(100, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(400)]  # one conversation with most rows
    rows += [(101, None, "user", "null turn"), (101, 5, "assistant", "a"), (101, 5, "assistant", "a"), (101, 5, "user", "b")]
    rows += [(None, 0, "user", "null conversation"), (None, 1, "assistant", "yes"), (102, -3, "assistant", "negative"), (102, -200, "user", "first")]
    return [(*r, "i", "m", 7, 8) for r in rows]


def talked(rows, order):
    """The contract's rows; ``order`` sorts the rows of one turn."""
    out, convs = {}, defaultdict(list)
    for r in rows:
        convs[r[0]].append(r)
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, order(r)))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def test_chat_round_trip(spark, vocabulary):
    rows = talk()
    table = spark.createDataFrame(rows, TALK).repartition(5)
    formatted = chat_format.format_conversations(table, vocabulary)
    streams = defaultdict(list)
    for r in formatted.orderBy("conv_id", "turn_no").collect():
        assert r.first_token == sum(map(len, streams[r.conv_id])) and r.turn_no == len(streams[r.conv_id]) and len(r.ids) == len(r.mask)
        streams[r.conv_id].append(list(r.ids))
    template = chat_format.Template()
    # rows of one turn go by their ids
    ids = {(r[2], r[3]): None for r in rows}
    single = spark.createDataFrame([(i, 0, *k) for i, k in enumerate(ids)], "conv_id long, turn long, role string, text string")
    of = {r.conv_id: r.ids[1:] for r in chat_format.format_conversations(single, vocabulary).collect()}
    ids = {k: of[i] for i, k in enumerate(ids)}
    want = talked(rows, lambda r: ids[r[2], r[3]])
    got = {r.conv_id: r for r in chat_format.read_back(formatted, vocabulary).collect()}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == want
    begin = template.ids(vocabulary.size)[template.begin]
    for conv, turns in streams.items():
        stream = [i for t in turns for i in t]
        assert stream.count(begin) == 1 and stream[0] == begin
        assert len(chat_format.formatted_text(stream, vocabulary)) == got[conv].formatted_chars


def read_text(text, template):
    """A reader of the formatted text that knows control strings only: [(role, text)]."""
    pattern = re.compile("|".join(re.escape(c) for c in sorted(template.controls, key=len, reverse=True)))
    pieces, at = [], 0
    for found in pattern.finditer(text):
        pieces += [text[at : found.start()], found.group()]
        at = found.end()
    assert text[at:] == "" and pieces[:2] == ["", template.begin]
    pieces, out = pieces[2:], []
    names = {template.user[0]: "user", template.system[0]: "system"}
    while pieces:
        body, mark, *pieces = pieces
        if mark == template.end:
            out.append(("assistant", body))
            continue
        assert body == ""
        role, close, *pieces = pieces if mark == template.role[0] else (names[mark], None, *pieces)
        body, _, *pieces = pieces
        out.append((role, body))
    return [(template.unescape(r), template.unescape(b)) for r, b in out]


def test_formatted_text_tells_turns_apart(spark, vocabulary):
    """Escaping is needed and enough: a reader of the text, without ids, finds every role and text again."""
    rows = [r for r in talk() if r[0] is not None and r[0] < 100]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    streams = defaultdict(list)
    for r in chat_format.format_conversations(spark.createDataFrame(rows, TALK), vocabulary).orderBy("conv_id", "turn_no").collect():
        streams[r.conv_id] += r.ids
    for conv, ids in streams.items():
        said = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        assert read_text(chat_format.formatted_text(ids, vocabulary), chat_format.Template()) == said


def test_chat_of_an_empty_table(spark, vocabulary):
    formatted = chat_format.format_conversations(spark.createDataFrame([], TALK), vocabulary)
    assert formatted.count() == 0 and chat_format.read_back(formatted, vocabulary).count() == 0


# -- documents of the two others


def documents():
    rng = random.Random(11)
    words = ["der", "and", "la", "é", "ÀB", "ab", "Straße", "日本", "the", "o'k", "A1b", "x-y", "Zwei", "zwei", "I", "İ"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(50)]
    out = []
    for i in range(260):
        n = rng.choice([0, 1, 1, 2, 3, 10, 10, 10, 40, 200])
        text = rng.choice([" ", "\n", ", "]).join(rng.choice(words) for _ in range(n))
        out.append((i, text, ["en", "en", "de", None, ""][i % 5], ["s1", "S2", None, "é", "s1", "s1", "z"][i % 7]))
    out += [(300 + i, "the and la the", "en", "s1") for i in range(40)]  # copies
    out += [out[9], out[9], (500, None, "en", "none"), (501, "12 ; 34", "xx", "a"), (502, "", "xx", "b"), (503, "word", "xx", "c"), (None, "the la", "en", "s1"), (None, "the la", "en", "s1"), (None, None, None, None), (504, "the " * 4000 + "zwei", "en", "s1")]
    return [(*r, "t", "p", "s", 1, 2, "i", 3) for r in out]


# -- 12 divergence


def diverging(rows, least, top):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for r in rows:
        lang, source = r[2] or "", r[3] or ""
        groups.add((lang, source))
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(r[1])))
        counts[lang, source].update(found)
        docs[lang].update(found.keys())
    out = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        others = [s for x, s in groups if x == lang]

        def smoothed(count, total, kept=kept):
            return 1 + 10**9 * (count + 5) // (total + 5 * len(kept)) if kept else 0

        def p(s, t, lang=lang, kept=kept):
            return smoothed(counts[lang, s][t], sum(counts[lang, s][x] for x in kept))

        q = {t: smoothed(sum(counts[lang, s][t] for s in others), sum(counts[lang, s][x] for s in others for x in kept)) for t in kept}
        pairs = sorted((-sum(abs(p(source, t) - p(s, t)) for t in kept), s) for s in others if s != source)
        over = sorted((q[t] - p(source, t), t) for t in kept if counts[lang, source][t] and p(source, t) > q[t])[:top]
        for part, found in (("pair", pairs), ("term", over)):
            out |= {(lang, source, part, item, -value, i + 1) for i, (value, item) in enumerate(found)}
    return out


@pytest.mark.parametrize("least,top,cells", [(30, 50, 300_000), (3, 2, 7)])
def test_divergence(spark, least, top, cells):
    docs = spark.createDataFrame(documents(), DOCS).repartition(4)
    found = divergence.audit_sources(docs, least_docs=least, top=top, cells=cells).collect()
    assert len(found) == len({tuple(r) for r in found})
    assert {tuple(r) for r in found} == diverging(documents(), least, top)


def test_stripes_take_no_step_per_term():
    """A document of 2,000 different terms runs through as few lines of the fold as one of two, and its counts are right;
    terms that are not UTF-8 are handed on with replacement characters."""
    import sys

    import pyarrow as pa

    def fold(texts):
        lines = 0

        def trace(frame, event, arg):
            nonlocal lines
            if frame.f_code.co_name != "stripes":
                return None
            lines += event == "line"
            return trace

        batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(["a", "b"] * (len(texts) // 2)), pa.array(texts, pa.binary())], ["lang", "source", "text"])
        sys.settrace(trace)
        try:
            out = list(divergence._stripes(300_000)(iter([batch])))
        finally:
            sys.settrace(None)
        cells = {(r["term"], c["source"]): (c["docs"], c["n"]) for b in out for r in b.to_pylist() for c in r["stripe"]}
        return lines, cells, sum(b.num_rows for b in out)

    many = ["".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(2000)]
    few, cells, _ = fold([b"ab cd ab", b"cd", b"", b"Cd \xff\xfe"])
    assert cells == {("ab", "a"): (1, 2), ("cd", "a"): (1, 1), ("cd", "b"): (2, 2), ("\ufffd\ufffd", "b"): (1, 1)}
    lines, cells, rows = fold([" ".join(many).encode()] * 3 + [b"aaa"])
    assert lines <= few + 10
    assert rows == 2000 and cells["aaa", "a"] == (2, 2) and cells["aaa", "b"] == (2, 2) and cells[many[-1], "b"] == (1, 1)


def test_divergence_in_pieces(spark, monkeypatch):
    """Sums handed on after every language and matrices of a row give the same result."""
    import pandas as pd

    rng = random.Random(2)
    names = [f"s{i}" for i in range(5)]
    stripes = [(lang, f"t{i}", s := sorted(rng.sample(names, rng.randint(1, 5))), [rng.randint(1, 90) for _ in s]) for i in range(60) for lang in ("a", "b")]
    languages = {lang: divergence._Sources([(n, sum(c for x, _, s, k in stripes if x == lang for m, c in zip(s, k, strict=True) if m == n)) for n in names], 60) for lang in ("a", "b")}
    frame = pd.DataFrame(stripes, columns=["lang", "term", "sources", "counts"])

    def run():
        out = pd.concat(divergence._diverge(languages, 3)(iter([frame.iloc[:50], frame.iloc[50:]])))
        pairs = out[out.part == "pair"].groupby(["lang", "source", "item"])["value"].sum().to_dict()
        return pairs, sorted(map(tuple, out[out.part == "term"].to_numpy().tolist()))

    whole = run()
    monkeypatch.setattr(divergence, "SUMS", 30)
    monkeypatch.setattr(divergence, "PIECE", 1)
    assert run() == whole


def test_probability_of_large_counts():
    import numpy as np

    rng = random.Random(4)
    for _ in range(300):
        total = rng.randint(0, 10 ** rng.randint(1, 15))
        count, kept = rng.randint(0, total), rng.randint(1, 10**6)
        assert divergence.probability(np.array([count]), total, kept)[0] == 1 + 10**9 * (count + 5) // (total + 5 * kept)


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit_sources(spark.createDataFrame([], DOCS)).count() == 0


# -- 13 lexical search

ITEMS = "item_id string, text string, term string, doc_id long, w long, rank int"


def items():
    out = [("a", "the and la"), ("b", "The THE the zwei"), ("c", "日本 é nowhere"), ("d", "nowhere"), ("e", ""), ("f", None), ("g", "o'k a1b x-y; wab wcb wdb"), ("a", "the and la"), ("a", "zwei"), (None, "straße")]
    out += [(f"all{i}", " ".join(f"w{chr(97 + (i + j) % 26)}a" for j in range(12))) for i in range(10)]
    return [(*r, "t", 1, 2, 3) for r in out]


def searched(rows, wanted, k):
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))

    docs = [(r[0], Counter(split(r[1]))) for r in rows]
    docs = [d for d in docs if d[1]]
    n, length = len(docs), sum(sum(c.values()) for _, c in docs)
    queries = defaultdict(set)
    for r in wanted:
        queries[r[0]].update(split(r[1]))
    out = Counter()
    for item, terms in queries.items():
        weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for t in terms if (df := sum(t in c for _, c in docs))}
        scores = []
        for id_, c in docs:
            m = 100 - 90 + (90 * sum(c.values()) * n) // length
            scores.append((-sum(w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c), id_ is None, id_ or 0, id_))
        for rank, s in enumerate(sorted(s[:3] for s in scores if s[0] < 0)[:k], 1):
            out[item, rank, None if s[1] else s[2], -s[0]] += 1
    return out


@pytest.mark.parametrize("part_terms,pass_terms,k", [(250_000, 200_000, 10), (15, 20, 3)])
def test_search(spark, part_terms, pass_terms, k):
    docs = spark.createDataFrame(documents(), DOCS).repartition(4)
    index = lexical_search.build_index(docs, part_terms=part_terms)
    found = lexical_search.search(index, spark.createDataFrame(items(), ITEMS).repartition(2), k=k, pass_terms=pass_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == searched(documents(), items(), k)


def test_index_is_stratified(spark):
    """Every part holds documents of one normaliser; a posting's places go by falling term frequency."""
    docs = spark.createDataFrame(documents(), DOCS)
    index = lexical_search.build_index(docs, part_terms=300)
    rows = index.postings.collect()
    assert sum(len(r.ids) for r in rows if r.term == "") == index.docs
    heads = {(r.m, r.part) for r in rows if r.term == ""}
    assert len(heads) > len({m for m, _ in heads})
    for r in rows:
        if r.term:
            assert (r.m, r.part) in heads and r.tfs == sorted(set(r.tfs), reverse=True) and r.top == r.tfs[0] and r.ends[-1] == len(r.docs) == r.df


def test_bounds_spare_parts(spark):
    """Parts that cannot hold a result are not visited: long documents whose bound is below the best scores."""
    rows = [(i, "needle " * 3 + "hay", "en", "s", *documents()[0][4:]) for i in range(20)]
    rows += [(100 + i, "needle " + "straw " * (200 + i), "en", "s", *documents()[0][4:]) for i in range(60)]
    index = lexical_search.build_index(spark.createDataFrame(rows, DOCS), part_terms=1000)
    parts = lexical_search._dealt(index.postings.select("m", "part", "term", "top"))
    items = [("x", [("needle", 100)])]
    best = 100 * lexical_search.impact(3, int(index.postings.agg({"m": "min"}).first()[0]))
    visits = parts.mapInArrow(lexical_search._visits(lexical_search._Items(items, {0: best})), "m long, part long, bound long").collect()
    assert len(visits) == 1 and index.postings.select("m", "part").distinct().count() > 10


def test_search_of_empty_tables(spark):
    docs, some = spark.createDataFrame(documents(), DOCS), spark.createDataFrame(items(), ITEMS)
    assert lexical_search.search(lexical_search.build_index(docs.limit(0)), some).count() == 0
    assert lexical_search.search(lexical_search.build_index(docs), some.limit(0)).count() == 0
