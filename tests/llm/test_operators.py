"""Every operator against a brute-force version on small tables with nulls, empty and long texts, ties, repeated rows
and extra columns; and on empty tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import decontaminate, exact_dedup, html_extract, language_id, mixing, ngram_join, substring_dedup, token_count, toxicity, url_filter, wordhash

SCHEMA = "doc_id long, text string, lang string, source string, key long, id string, size int, label int, class string, words string, found string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def texts(seed=5, n=90):
    rng = random.Random(seed)
    vocab = ["der", "and", "la", "é", "ÀB", "x1", "Straße", "日本", "the", "o'k", "A", "b", "foo-bar", "zwei"] + [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    out = []
    for i in range(n):
        t = rng.choice([" ", "  ", "\n", "\t"]).join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 9, 20, 50, 120])))
        if i % 7 == 0:
            t += " " + passage
        out.append(t)
    base = " ".join(rng.choice(vocab) + str(rng.randint(0, 999)) for _ in range(80))
    for _ in range(12):  # near copies
        w = base.split()
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += [out[3], out[3].upper(), out[10], base, base, "la " * 200, "x" * 5000, " ".join(["ab"] * 40), "\u00a0a", "", "", None, None, "Ä ä", "ä ä"]
    return out


def rows(with_repeats=True):
    out = [(i, t, ["en", "de", None][i % 3], ["s1", "S2", None, "é"][i % 4 if i % 5 else 0], 1, "a", 2, 3, "c", "w", "f") for i, t in enumerate(texts())]
    if with_repeats:
        out += [out[3], out[95], (None, "null id", "en", "s1", 1, "a", 2, 3, "c", "w", "f"), (None, None, None, None, None, None, None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(found):
    return Counter(tuple(r) for r in found.collect())


# -- 1 exact dedup


@pytest.mark.parametrize("capacity", [65536, 3])
def test_exact_dedup(docs, capacity):
    groups = defaultdict(list)
    for r in rows():
        groups[lower(r[1])].append(r[0])
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    found = exact_dedup.exact_dedup(docs, capacity=capacity, max_depth=12)
    assert bag(found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == want


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(4000).selectExpr("xxhash64(id) AS key").unionByName(spark.range(300).selectExpr("shiftleft(1L, 62) + id AS key"))
    found = exact_dedup.build_directory(keys, 100, 2, 10).collect()
    assert sum(r.n for r in found) == 4300 and len({r.depth for r in found}) > 1
    assert all(r.n <= 100 or r.depth == 10 for r in found) and max(r.n for r in found) >= 300
    assert sum(2.0**-r.depth for r in found) <= 1  # buckets do not overlap


def test_colliding_keys_are_chained(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    found = exact_dedup.exact_dedup(spark.createDataFrame([(1, "a"), (2, "A"), (3, "b"), (4, "c")], "doc_id long, text string"))
    assert {r.doc_id: (r.keep_id, r.group_size) for r in found.collect()} == {1: (2, 2), 2: (2, 2), 3: (3, 1), 4: (4, 1)}
    assert {r.chain_no for r in found.collect()} == {1, 2, 3}


def test_directory_decides_ownership_and_lookup(spark):
    """A bucket is written by one owner and no bucket is overfull; a key whose pointer is missing is not found."""
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(i, f"text {i % 700}") for i in range(1000)], "doc_id long, text string").repartition(3)
    index = exact_dedup.build_index(table, capacity=40, max_depth=14)
    owners = index.entries.groupBy("bucket").agg(F.countDistinct("_metadata.file_path").alias("files"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in owners) == 700 and all(r.files == 1 and r.n <= 40 for r in owners) and len(owners) > 16
    found = index.bucket_of(index.entries, "key")
    assert found.where("bucket <> of_bucket").isEmpty() and found.count() == 700
    gone = owners[0].bucket
    cut = exact_dedup.Index(index.entries, index.directory.where(F.col("of_bucket") != gone), index.depth)
    assert cut.bucket_of(index.entries, "key").count() == 700 - owners[0].n


def test_native_plan_of_exact_dedup(docs):
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# -- 2 url filter

URLS = [
    "http://a.example.net/en/1", "https://example.net/de/1?x", "HTTP://WWW.Example.COM/de/#t", "http://notexample.com/de/x", "http://example.com/den", "ftp://x.org/fr/",
    "http://org/fr/x", "http://x.org", "no scheme net/", "http://", "", None, "http://net/", "http://net", "://example.com/de/x", "http://u@a.net:80/en/", "http://a..net/", "http://x.net?/en/",
    "http://example.net/en", "http://b.c.example.net/en/://y", "http://" + "a." * 3000 + "net/" + "p/" * 3000, "x://É.NET/\n/",
]


def brute_url(url, rules, default="allow"):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (lower(m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), a == "block", h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


def test_url_filter(spark):
    rules = [*url_filter.RULES, ("block", "c.example.net", "/en"), ("allow", "b.c.example.net", "/e")]
    urls = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(0, URLS[0], "x", "y"), (None, URLS[1], None, None)]
    pages = spark.createDataFrame(urls, "page_id long, url string, host string, rule string")
    for own in (url_filter.RULES, rules):
        want = Counter((i, *brute_url(u, own)) for i, u, _, _ in urls)
        assert bag(url_filter.filter_urls(pages, url_filter.rules_table(spark, own)).select("page_id", "host", "path", "rule", "verdict")) == want
    assert {r.verdict for r in url_filter.filter_urls(pages, url_filter.rules_table(spark, [])).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), url_filter.rules_table(spark, rules)).count() == 0


# -- 3 language


def test_language(spark, docs):
    rng = random.Random(3)
    own = {"en": "the of and with this house".split(), "de": "der und nicht mit das straße".split(), "fr": "le été la avec où maison".split()}
    made = [(i, " ".join(rng.choice(own[g]) for _ in range(rng.randint(3, 40))), g) for i, g in enumerate(rng.choice(list(own)) for _ in range(400))]
    made += [(1000, None, "en"), (1001, "", "en"), (1002, "12 ½ ² !!", "de"), (1003, "hausstraßen", None), (1004, "der und " * 50_000, "fr"), (1004, "der und " * 50_000, "fr"), (None, "the house", "de")]
    frame = spark.createDataFrame(made, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language_id.identify_language(frame).collect()}
    lang = {i: g for i, _, g in made}
    right = [found[i].lang_pred == lang[i] for i in range(400) if found[i].held_out]
    assert len(right) > 50 and sum(right) / len(right) > 0.97
    assert [found[i].lang_pred for i in (1000, 1001, 1002, 1003, 1004, None)] == ["und", "und", "und", "de", "de", "en"]
    assert all(0 <= r.score <= 1 for r in found.values()) and found[1000].score == 0 and found[None].held_out is False
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items() if i is not None)


def test_language_without_labels(spark, empty):
    frame = spark.createDataFrame([(1, "the house", None)], "doc_id long, text string, lang string")
    assert language_id.identify_language(frame).first()[2:] == ("und", 0.0)
    assert language_id.identify_language(empty).count() == 0


def test_back_off_goes_to_shorter_grams():
    model = language_id.Model(["a", "b"], ["the", "hous", "ho", "z"], 1, np.log(np.array([[0.9, 0.1], [0.2, 0.8], [0.7, 0.3], [0.4, 0.6]])))
    one = language_id.Identifier(model)
    assert one.predict("the")[0] == "a" and one.predict("houses")[0] == "b" and one.predict("hot")[0] == "a" and one.predict("z")[0] == "b"
    one.SLICE, one.room = 3, 0
    assert one.predict("the hot houses " * 20_000)[0] in ("a", "b")


# -- 4 token counts


@pytest.fixture(scope="module")
def model():
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    return open(path, "rb").read()


def test_transducer_counts_as_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    machine = token_count.Transducer(token_count.read_pieces(model))
    rng = random.Random(1)
    signs = "  ▁ab etion\n\té½ａ0<s>1/_。ß漢字🙂́"
    cases = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(4000)] + [" " * k + "x" * (k % 2) for k in range(60)]
    cases += [t for t in texts() if t] + ["<s></s><unk><0x0A>", "abc" * 3000, "antidisestablishmentarianism" * 50]
    want = [len(e) for e in library.encode(cases)]
    for chunk in (1, 2, 5, 17, 65536):
        assert token_count.count_tokens(machine, cases, chunk) == want
    machine.MAX_STATES, machine.MAX_WORDS, machine.MAX_PAIRS = 20, 10, 10
    assert token_count.count_tokens(machine, cases, 65536) == want


def test_token_counts_query(docs, empty, model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    want = Counter((r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "")), n > 100) for r in rows())
    assert bag(token_count.count_document_tokens(docs, model, limit=100)) == want
    assert token_count.count_document_tokens(empty, model).count() == 0


def test_maps_compose_associatively(model):
    machine = token_count.Transducer(token_count.read_pieces(model))
    rng = random.Random(2)
    for _ in range(300):
        parts = [token_count.chunk_map(machine, "".join(rng.choice("▁▁ab") for _ in range(rng.randint(1, 5)))) for _ in range(3)]
        one = token_count.compose(machine, token_count.compose(machine, parts[0], parts[1]), parts[2])
        two = token_count.compose(machine, parts[0], token_count.compose(machine, parts[1], parts[2]))
        assert (one.head, one.count, one.tail) == (two.head, two.count, two.tail)


# -- 5 mixing


def test_targets_share_what_is_above():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    assert mixing.targets([10, 10, 980], [1, 2, 3]) == [30, 30, 940]
    assert mixing.targets([0, 5], [1, 2]) == [0, 5] and mixing.targets([], []) == []


def test_mix(docs, empty):
    found, slots, plan = mixing.mix_sources(docs, block_words=4, shard_slots=16)
    got = found.collect()
    sizes = defaultdict(int)
    for r in rows():
        sizes[r[3]] += len(words(r[1]))
    assert plan.names == ["S2", "s1", "é", None]
    assert Counter((r.doc_id, r.source, r.size, r.source_size) for r in got) == Counter((r[0], r[3], len(words(r[1])), sizes[r[3]]) for r in rows())
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for name, target in zip(plan.names, plan.targets, strict=True):
        assert abs(taken[name] - target) <= 2 * 4
    assert sum(plan.targets) == pytest.approx(sum(sizes.values()))
    per = Counter((r.source_no, r.block) for r in slots.collect())
    assert max(per.values()) <= 3 and sum(per.values()) == plan.slots.sum()
    again, _, _ = mixing.mix_sources(docs.repartition(7), block_words=4, shard_slots=16)
    assert bag(again) == bag(found)
    assert mixing.mix_sources(empty)[0].count() == 0


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(mixing.permute(np.arange(n), n, 9).tolist()) == list(range(n))
    assert mixing.permute(np.arange(1000), 1000, 1).tolist() != mixing.permute(np.arange(1000), 1000, 2).tolist()


# -- 6 n-gram join


def brute_sets(own, n=4):
    sets = []
    for r in own:
        w = words(lower(r[1]))
        k = min(n, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    return sets


def brute_components(own, percent):
    sets = brute_sets(own)
    parent = list(range(len(own)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(own)):
        for j in range(i):
            inner = len(sets[i] & sets[j])
            if inner and 100 * inner >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(own):
        smallest[find(i)] = min(smallest.get(find(i), r[0]), r[0])
    return {(r[0], len(s), smallest[find(i)]) for i, (r, s) in enumerate(zip(own, sets, strict=True))}


@pytest.mark.parametrize("percent", [85, 60, 100])
def test_components(spark, percent):
    own = rows(with_repeats=False)
    found = ngram_join.similar_components(spark.createDataFrame(own, SCHEMA).repartition(4), percent=percent)
    assert {tuple(r) for r in found.collect()} == brute_components(own, percent)


def test_components_of_chains_and_hot_groups(spark, monkeypatch):
    """Copies that are only similar to their neighbours, signatures dealt over tasks, small blocks, and small sets."""
    monkeypatch.setattr(ngram_join, "HOT_SHARE", 0.0)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rng = random.Random(8)
    w = [f"v{i}" for i in range(70)]
    own = []
    for i in range(60):
        own.append((1000 - i, " ".join(w)))
        w = [*w[2:], f"n{rng.random()}", f"m{rng.random()}"]
    own += [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))) for i in range(150)]
    found = ngram_join.similar_components(spark.createDataFrame(own, "doc_id long, text string").repartition(5))
    assert {tuple(r) for r in found.collect()} == brute_components(own, 85)


def test_component_edges(spark, empty):
    own = [(1, "a b c d e f g h"), (1, "other words that stand here now"), (2, "A b C d E f g h"), (2, "A b C d E f g h"), (None, "a b c d e f g h"), (3, None), (4, ""), (5, " \n"), (6, "a b c d e f g h")]
    found = ngram_join.similar_components(spark.createDataFrame(own, "doc_id long, text string")).collect()
    comp = {r.doc_id: r.component_id for r in found}
    assert len(found) == len(own) and comp[2] == comp[6] and comp[None] is None and [comp[i] for i in (3, 4, 5)] == [3, 4, 5]
    assert sorted(r.n_shingles for r in found) == [0, 0, 0, 3, 5, 5, 5, 5, 5]
    assert ngram_join.similar_components(empty).count() == 0


@pytest.mark.parametrize("percent,cells", [(85, 3), (80, 3), (85, 1), (60, 3)])
def test_similar_sets_share_a_signature(percent, cells):
    rng = np.random.default_rng(4)
    bands = ngram_join.Bands(percent, cells)
    for size in [*range(1, 40), 100, 333, 1000]:
        for _ in range(6):
            x = rng.integers(0, 2**63, size, dtype=np.uint64)
            most = size * (100 - percent) // percent
            for grow in {0, most // 2, most}:
                y = np.concatenate([x, rng.integers(0, 2**63, grow, dtype=np.uint64)])
                if 100 * len(x) >= percent * len(y):
                    assert np.intersect1d(bands.signatures(x), bands.signatures(y)).size
            for swap in range(size):
                if 100 * (size - swap) < percent * (size + swap):
                    break
                y = np.concatenate([x[swap:], rng.integers(0, 2**63, swap, dtype=np.uint64)])
                assert np.intersect1d(bands.signatures(x), bands.signatures(y)).size


def test_signatures_are_of_subsets_of_cells():
    """A change of one element leaves one of the subsets of its partition: two thirds of the signatures go, not all three."""
    rng = np.random.default_rng(6)
    bands = ngram_join.Bands(85)
    x = rng.integers(0, 2**63, 95, dtype=np.uint64)  # a size that signs for one band
    y = x.copy()
    y[0] = 12345
    (b,) = bands.of_set(len(x))
    parts = bands.bands[b][3]
    mine, other = bands.signatures(x), bands.signatures(y)
    assert 0.9 * 3 * parts <= len(mine) <= 3 * parts and np.setdiff1d(mine, other).size in (2, 4)


def test_sketches_never_hide_a_similar_pair():
    rng = np.random.default_rng(1)
    for size in (1, 7, 60, 600, 3000):
        x = rng.integers(0, 2**63, size, dtype=np.uint64)
        for swap in {0, 1, size // 20, size // 8, size // 2}:
            y = np.concatenate([x[swap:], rng.integers(0, 2**63, 2 * swap, dtype=np.uint64)])
            a, b = ngram_join.sketch(x), ngram_join.sketch(y)
            width = min(len(a), len(b))
            cells = ngram_join._same_cells([a, b], width)
            assert np.bitwise_count(cells[0] ^ cells[1]).sum() <= 3 * swap


# -- 7 decontamination


def brute_decontaminate(own, items, size=13):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    out = Counter()
    for r in own:
        w = split(r[1])
        hit, ids = set(), set()
        for item, text in items:
            p = split(text)
            for k in range(max(1, len(p) - size + 1) if p else 0):
                win = p[k : k + size]
                for i in range(len(w) - len(win) + 1):
                    if w[i : i + len(win)] == win:
                        hit |= set(range(i, i + len(win)))
                        ids.add(str(item))
        out[r[0], len(w), len(hit), ",".join(sorted(ids)), len(hit) > 0 and 20 * len(hit) >= len(w)] += 1
    return out


@pytest.mark.parametrize("max_bytes", [64_000_000, 40])
def test_decontamination(spark, docs, empty, max_bytes):
    base = [t for t in texts() if t and len(t) > 300]
    items = [(1, base[0]), (12, "the LA, and"), (2, " ".join(base[1].split()[5:20])), (3, None), (4, "?!"), (5, "é"), (6, "la la la"), (7, "changed!"), (7, "la la la")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.decontaminate(docs, bench, max_bytes=max_bytes)
    got = Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids), r.contaminated) for r in found.collect())
    assert got == brute_decontaminate(rows(), items)
    assert decontaminate.decontaminate(empty, bench).count() == 0
    none = decontaminate.decontaminate(docs, bench.limit(0))
    assert {(r.n_hit, r.contaminated, tuple(r.item_ids)) for r in none.collect()} == {(0, False, ())}


def test_word_offsets_point_into_the_original():
    text = "Ä-b  C?1é"
    assert [text[a:b] for a, b in decontaminate.word_offsets(text)] == ["Ä", "b", "C", "1é"]
    assert [w.decode() for w in decontaminate.normalise(text)] == ["Ä", "b", "c", "1é"]


# -- 8 substring dedup


def brute_substrings(own, window):
    seen = Counter()
    split = [words(r[1]) for r in own]
    for w in split:
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = Counter()
    for r, w in zip(own, split, strict=True):
        gone = {k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(i, i + window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("window", "bucket"), [(35, 4096), (6, 4096), (6, 2), (3, 1)])
def test_substring_dedup(docs, window, bucket, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BUCKET", bucket)
    found = substring_dedup.substring_dedup(docs, window=window)
    assert bag(found.select("doc_id", "n_words", "n_removed", "kept_sha256")) == brute_substrings(rows(), window)
    assert all(sum(s.last - s.first + 1 for s in r.spans) == r.n_removed for r in found.collect())


def test_substring_dedup_of_nothing(empty):
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_kept_text():
    assert substring_dedup.kept_text("a b\nc  d", [{"first": 1, "last": 2}]) == "a d" and substring_dedup.kept_text(None, []) == ""


def test_word_hashes():
    for t in texts():
        data = wordhash.encode(t)
        got, w = wordhash.word_hashes(data), words(t)
        assert len(got) == len(w) and len(set(got.tolist())) == len(set(w))
        assert (wordhash.word_hashes(wordhash.encode(" ".join(w))) == got).all()


# -- 9 html

PAGE = """<!DOCTYPE html><html lang="en"><head><title>No {n}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<div class="site-header"><header>Site</header></div><nav><ul><li><a href="/a">Menu {n}</a></ul></nav><div class="ad">Buy {n}</div>
<article><h1>Title &amp; {n}</h1><p>First
 <b>bold {n}<br><p>Second &copy; {n} &lt;x&gt;<div class="share-buttons">Share this</div><ul><li>one<li>two {n}</ul>
<aside>side</aside><p>Last<script>no()</script> words</p></article><section class="comments"><article class="comment">I disagree {n}</article></section>
<form><p>Name</p></form><footer>&copy; {n}</footer>"""
WANT = "Title & {n}\nFirst bold {n}\nSecond © {n} <x>\none\ntwo {n}\nLast words"


def test_extraction(spark):
    made = [(n, f"http://h.example/{n}", PAGE.format(n=n)) for n in range(12)]
    made += [(90, "http://h.example/x", None), (91, None, "<p>lone <b>text"), (92, "http://h.example/y", ""), (93, "bad", "plain &eacute; text"), (93, "bad", "plain &eacute; text"), (None, "http://o.example/", "<div>" * 3000 + "deep" + "</div>" * 3000)]
    pages = spark.createDataFrame([(*r, "w", "t") for r in made], "page_id long, url string, html string, wrapper string, host string")
    got = bag(html_extract.extract_pages(pages).select("page_id", "text", "n_chars"))
    want = Counter((n, t := WANT.format(n=n), len(t)) for n in range(12))
    want.update([(90, "", 0), (91, "lone text", 9), (92, "", 0), (93, "plain é text", 12), (93, "plain é text", 12), (None, "deep", 4)])
    assert got == want
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_wrapper_tells_template_from_slots():
    pages = [f"<html><body><article><h1>T{n}</h1><p>text {n} of some length</p><div class='box'>Same on all</div></article></body></html>" for n in range(4)]
    wrapper = html_extract.induce(pages)
    assert list(wrapper["template"].values()) == ["Same on all"] and wrapper["roots"] == ["/html/body/article"]
    assert html_extract.extract(pages[2], wrapper) == "T2\ntext 2 of some length"
    copies = html_extract.induce([pages[0]] * 4)
    assert html_extract.extract(pages[0], copies) == "T0\ntext 0 of some length\nSame on all"


def test_whole_pages_are_not_lost():
    text = "<h1>Title</h1><p>One long paragraph of the page.</p><p>Another paragraph.</p>"
    want = "Title\nOne long paragraph of the page.\nAnother paragraph."
    for page in (
        f"<html><head><title>t</title><meta name=a><body>{text}</body></html>",
        f"<head><title>t</title><script>x<y</script>{text}",
        f"<head><title>t</title><style>p {{}}</style><div>{text}</div>",
        f"<html><body><form action='/'>{text}</form></body></html>",
        f"<html><body><div>Menu</div><form><div class=share>Share</div><article>{text}</article></form></body></html>",
        f"<html><body><article class='notice-page'>{text}<div class=related>Other</div></article></body></html>",
        f"<html><body><div id='social-widget'>{text}<form>Name</form></div></body></html>",
        f"<html><body>{text}<section class=comments><p>{'Much longer words of readers. ' * 20}</p></section></body></html>",
        f"<html><body><article>{text}</article><div class=widget>{'Much longer box. ' * 20}</div></body></html>",
    ):
        assert html_extract.extract(page) == want, page
    assert html_extract.extract("<head>lone words<p>more") == "lone words\nmore"


HOSTS = {
    "no article or main": (
        "<html><body><ul class='kopfzeile'><li><a href='/'>Start</a><li><a href='/x'>Kontakt</a></ul><div>Same notice on all pages</div><div class='inhalt{n}'>"
        "<h2>Head {n}</h2>Words {n} that differ<p>More words {n} of the page</p><p>Write to us</p><p>And words {n} again, they go on</p></div><p>Same footer</p></body></html>",
        "Head {n}\nWords {n} that differ\nMore words {n} of the page\nWrite to us\nAnd words {n} again, they go on",
    ),
    "no box for the text": (
        "<html><body><ul><li><a href='/'>Start</a><li>Kontakt</ul><p>Same notice</p><h1>Head {n}</h1><p>Words {n} that differ</p><div><p>Our shop</p></div><p>Write to us</p>"
        "<p>More words {n} of the page</p><p>Same footer</p><div>Imprint</div></body></html>",
        "Head {n}\nWords {n} that differ\nWrite to us\nMore words {n} of the page",
    ),
    "main around an article": (
        "<html><body><div>Menu</div><main><h1>Head {n}</h1><p>Lead {n} of the text</p><article><p>Body {n} of the text</p></article></main><div>Same on all</div></body></html>",
        "Head {n}\nLead {n} of the text\nBody {n} of the text",
    ),
}


@pytest.mark.parametrize("page, want", HOSTS.values(), ids=list(HOSTS))
def test_aligned_trees_decide(page, want):
    pages = [page.format(n=n) for n in range(5)]
    wrapper = html_extract.induce(pages)
    assert [html_extract.extract(p, wrapper) for p in pages] == [want.format(n=n) for n in range(5)]


def test_wrappers_of_all_pages(spark):
    """Two layouts with notices of their own, a box that few pages miss, and an author that is on most pages only."""
    pages, want = [], []
    for n in range(40):
        author = "Ann" if n % 5 else "Bob"
        body = f"<h1>Head {n}</h1><p>Words {n} that differ</p><div>By {author}</div>"
        if n % 2:
            html = f"<html><body><div>Notice one</div><article>{body}</article><div>Imprint one</div></body></html>"
        else:
            html = f"<html><body><section>{'' if n == 4 else '<div>Notice two</div>'}{body}<div>Imprint two</div></section></body></html>"
        pages.append((n, f"http://h.example/{n}", html))
        want.append((n, f"Head {n}\nWords {n} that differ\nBy {author}"))
    found = html_extract.extract_pages(spark.createDataFrame(pages * 2, "page_id long, url string, html string").repartition(5))
    assert Counter((r.page_id, r.text) for r in found.collect()) == Counter(want * 2)


def test_near_copies_are_no_template():
    prose = "".join(f"<p>Paragraph {i} that all pages share</p>" for i in range(20))
    pages = [f"<html><body><div>{n} May</div><div>{prose}</div></body></html>" for n in range(5)]
    wrapper = html_extract.induce(pages)
    assert all(html_extract.extract(p, wrapper).count("that all pages share") == 20 for p in pages)


def test_tree_matching_counts_pairs():
    one = html_extract.Shape([html_extract.parse("<div><p>a</p><ul></ul><b>x</b></div>")])
    two = html_extract.Shape([html_extract.parse("<div><p>a</p><i></i><b>y</b></div>")])
    pairs = []
    assert html_extract.match(one, two, pairs) == 4 == len(pairs)


# -- 10 toxicity


def test_toxicity(spark, empty):
    rng = random.Random(4)
    clean = [f"w{i}" for i in range(300)]
    made, labels = [], []
    for i in range(1200):
        w = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        bad = rng.random() < 0.15
        if bad:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "scum", "zorgo" + rng.choice(["an", "est", "ly"])]))
        made.append((i, " ".join(w), "x", 1.0))
        if i % 4 != 1:
            labels.append((i, int(bad), 0))
    made += [(5000, None, "x", 1.0), (5001, "", "x", 1.0), (None, "you idiot", "x", 1.0), (5002, "w1 " * 100_000 + "zorgoly", "x", 1.0), (5003, "1d1ot id1ot", "x", 1.0), (0, made[0][1], "x", 1.0)]
    labels += [(7, None, 0), (None, 1, 0), labels[0]]
    docs = spark.createDataFrame(made, "doc_id long, text string, toxic string, score double")
    found = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")).collect()
    truth = {i: any(re.search(r"idiot|scum|zorgo", t or "") for _, t, _, _ in [r]) for r in made for i, t, _, _ in [r]}
    assert len(found) == len(made) and all(0 <= r.score <= 1 for r in found)
    plain = [r for r in found if r.doc_id is not None and r.doc_id < 5000]
    assert sum(r.predicted == truth[r.doc_id] for r in plain) / len(plain) > 0.99
    other = {r.doc_id: r.predicted for r in found if r.doc_id is None or r.doc_id >= 5000}
    assert other[5000] == other[5001] == 0 and other[None] == 1 and other[5002] == 1
    assert toxicity.score_toxicity(empty, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_correlated_voters_share_their_say():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    one = np.where(rng.random(4000) < np.where(y, 0.7, 0.1), 1, -1)
    three = np.where(rng.random(4000) < np.where(y, 0.8, 0.2), 1, -1)
    votes = np.stack([one, one, one, three], axis=1)
    fired = votes == 1
    anchors = np.stack([fired[~y].sum(0), fired[y].sum(0), np.full(4, (~y).sum()), np.full(4, y.sum())], axis=1) * 0.5
    p, accuracy, weights = toxicity.fit_label_model(votes, 0.3, anchors)
    assert weights[0] < 0.5 < weights[3] and (accuracy > 0.6).all() and np.corrcoef(p, y)[0, 1] > 0.6


# -- faults found in trials


def test_mix_takes_from_small_sources(spark):
    """Every source comes near its target, also where a source is smaller than a block."""
    own = [(k, "w " * n, s) for k, (s, n) in enumerate([("a", 100), ("b", 100), ("c", 300), ("d", 100), ("e", 3), ("f", 5000)])]
    documents, slots, plan = mixing.mix_sources(spark.createDataFrame(own, "doc_id long, text string, source string"))
    for r in documents.collect():
        assert abs(r.taken - r.target) <= max(1, 0.01 * r.source_size) and r.taken <= 3 * r.size
    first = mixing.make_plan({"a": 100, "b": 100, "c": 300, "d": 100}, 256)
    taken = first.slots * first.block_words
    assert (abs(taken - first.targets) <= 1).all() and [round(t, 1) for t in first.targets] == [85.7, 171.4, 257.1, 85.7]


def test_items_without_id_have_windows(spark):
    words_ = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, words_), (2, "nothing of that"), (None, words_)], "doc_id long, text string")
    items = spark.createDataFrame([(None, words_), ("b", "q1 q2"), (None, None)], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: (20, 20, ["b", None], True), 2: (3, 0, [], False), None: (20, 20, ["b", None], True)}


def test_template_of_a_rare_layout(spark):
    """Five of 600 pages of a host have a layout of their own: its constant lines are template as well."""
    pages, want = [], []
    for n in range(600):
        body = f"<h1>Head {n}</h1><p>Words {n} that differ {'x' * (n % 9)}</p>"
        if n % 120 == 7:
            html = f"<html><body><section><div>Rare notice</div><div><div>{body}</div></div><div>Rare imprint</div></section></body></html>"
        else:
            html = f"<html><body><div>Notice</div><article>{body}</article><div>Imprint</div></body></html>"
        pages.append((n, f"http://h.example/{n}", html))
        want.append((n, f"Head {n}\nWords {n} that differ{' ' * bool(n % 9)}{'x' * (n % 9)}"))
    found = html_extract.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4))
    assert {(r.page_id, r.text) for r in found.collect()} == set(want)


@pytest.mark.parametrize("block,shard", [(7, 5), (256, 1024)])
def test_mixed_words_are_the_slots_blocks(spark, docs, block, shard):
    """Every place of every shard holds the words of its slot's block, replayed from the packing order; documents' words add up."""
    import pyspark.sql.functions as F

    kw = {"block_words": block, "shard_slots": shard}
    documents, slots, plan = mixing.mix_sources(docs, **kw)
    packed = docs.select(F.col("source"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("tie"), "doc_id").collect()
    stream = defaultdict(list)
    for r in sorted(packed, key=lambda r: (r.tie % 2**64, r.doc_id is not None, r.doc_id or 0)):
        stream[r.source] += words(r.text)
    want = Counter()
    for s in slots.collect():
        n = int(plan.block_words[s.source_no])
        want[s.shard, plan.names[s.source_no], " ".join(stream[plan.names[s.source_no]][s.block * n : (s.block + 1) * n])] += 1
    places, taken = defaultdict(list), Counter()
    for r in mixing.mix_words(docs, **kw).collect():
        assert len(words(r.text)) == r.words > 0
        places[r.shard, r.source, r.place].append((r.at, r.words, r.text))
        taken[r.doc_id] += r.words
    got = Counter()
    for (shard_, source, _), parts in places.items():
        parts.sort()
        assert [p[0] for p in parts] == [sum(p[1] for p in parts[:i]) for i in range(len(parts))]
        got[shard_, source, " ".join(p[2] for p in parts)] += 1
    assert got == want and len(want) > 3
    sums = Counter()
    for r in documents.collect():
        sums[r.doc_id] += r.taken
    assert +sums == taken


def test_mixed_words_of_an_empty_table(spark, empty):
    assert mixing.mix_words(empty).count() == 0
