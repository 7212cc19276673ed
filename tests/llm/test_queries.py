"""The registered queries against their SQL on the small test tables, and the pipeline against the stages' rules."""

from __future__ import annotations

import os

import pytest

from ledgerline.llm import queries as llm

SF_SMALL = "/root/testdata/sf0.001"
ORACLE = llm.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def normal(rows):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", list(llm.queries()))
def test_query(spark, connection, name):
    found = llm.queries()[name](spark, SF_SMALL)
    columns = sorted(found.columns)
    got = found.select(columns).collect()
    if not name.startswith(("op11_", "op12_", "op13_")):  # those have a row per conversation, group or item
        table = "pages" if name.startswith(("op2_", "op9_")) else "documents"
        assert len(got) == spark.read.parquet(os.path.join(SF_SMALL, f"{table}.parquet")).count()
    if name in ORACLE:
        rel = connection.execute(ORACLE[name])
        names = [d[0] for d in rel.description]
        want = [tuple(r[names.index(c)] for c in columns) for r in rel.fetchall()]
        assert sorted(names) == columns and normal(got) == normal(want)


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    from ledgerline.llm import decontaminate, exact_dedup, language_id, ngram_join

    assert [n for n, _ in pipeline.STAGES] == ["language", "exact", "near", "decontaminated", "mixed"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in pipeline.STAGES[:-1]:
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "language":
            kept = {r.doc_id for r in language_id.identify_language(docs).where("lang_pred <> 'und'").collect()}
        elif name == "exact":
            kept = {r.doc_id for r in exact_dedup.exact_dedup(docs).where("kept").collect()}
        elif name == "near":
            kept = {r.component_id for r in ngram_join.similar_components(docs, n=5, percent=80).collect()}
        else:
            kept = {r.doc_id for r in decontaminate.decontaminate(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).where("NOT contaminated").collect()}
        docs = stage(spark, docs, SF_SMALL).cache()
        assert docs.columns == columns and {r.doc_id for r in docs.collect()} == kept and kept <= ids
    final = pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in final.collect()} <= kept
    assert {tuple(r) for r in final.collect()} == {tuple(r) for r in pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()}


@pytest.mark.parametrize("stage", range(5))
def test_stage_on_an_empty_table(spark, stage):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    assert pipeline.STAGES[stage][1](spark, docs, SF_SMALL).count() == 0


def test_exact_stage_keeps_one_row_a_group(spark):
    import corpus_pipeline as pipeline

    rows = [(1, "a b", "en", "s", 3), (2, "A b", "en", "s", 3), (2, "A b", "en", "s", 3), (3, "c", None, None, 1), (None, "d", "x", "s", 1), (None, "c", "x", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in dict(pipeline.STAGES)["exact"](spark, docs, SF_SMALL).collect()]
    assert sorted(got, key=str) == sorted([rows[1], rows[3], rows[4], rows[6]], key=str)


def test_language_stage_without_languages_keeps_texts_with_letters(spark):
    import corpus_pipeline as pipeline

    rows = [(1, "some words", None, "s", 10), (2, "12 34", None, "s", 5), (3, None, None, "s", None), (None, "ä", None, "s", 1), (5, "", None, "s", 0), (1, "some words", None, "s", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in dict(pipeline.STAGES)["language"](spark, docs, SF_SMALL).collect()]
    assert sorted(got, key=str) == sorted([rows[0], rows[3], rows[5]], key=str)


def test_near_stage_takes_five_words_and_80_percent(spark):
    """Against all pairs, with near copies whose similarity is between 0.80 and 0.85 and just under 0.80."""
    import random

    import corpus_pipeline as pipeline

    rng = random.Random(5)
    rows, sets, between = [], {}, 0
    for i in range(30):
        w = [f"w{rng.random()}" for _ in range(104)]
        cut = 14 + i % 10  # of 100 runs of five words, as many are cut as words: 0.86 down to 0.77
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[cut:]))]
    for id_, text in rows:
        w = text.split()
        sets[id_] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    gone = set()
    for i in range(30):
        x, y = sets[2 * i], sets[2 * i + 1]
        if 100 * len(x & y) >= 80 * len(x | y):
            gone.add(2 * i + 1)
            between += 100 * len(x & y) < 85 * len(x | y)
    assert 0 < between < len(gone) < 30
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in dict(pipeline.STAGES)["near"](spark, docs, SF_SMALL).collect()}
    assert got == set(sets) - gone


def test_entry_without_the_subpackage(tmp_path):
    """The entry module works when this folder and the pipeline are gone."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(os.path.join(root, "ledgerline"), tmp_path / "ledgerline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; assert 'top_products' in e.queries() and 'pipeline' not in e.queries() and not [q for q in e.oracle_sql() if q.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


CLASHES = ["kept_id", "kept_sha", "own_sha", "found_language", "found_windows", "found", "row", "sha", "told", "component_id", "size", "id"]


@pytest.mark.parametrize("stage", ["language", "exact", "near", "decontaminated"])
def test_stages_keep_columns_of_any_name(spark, stage):
    """Columns named like those that the stages make come through unchanged, nulls and repeated rows included."""
    import corpus_pipeline as pipeline

    texts = ["some words of a text that is long enough", "SOME words of a text that is long enough", "other words of quite another text here", None, "", "12"]
    rows = [(i if i != 2 else None, t, ["en", None][i % 2], "s", 1, *[f"{c}-{i}" for c in CLASHES]) for i, t in enumerate(texts)]
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES))
    got = dict(pipeline.STAGES)[stage](spark, docs, SF_SMALL)
    found = [tuple(r) for r in got.collect()]
    assert got.columns == docs.columns and set(found) <= set(rows) and rows[2] in found
    if stage == "exact":
        assert sorted(map(str, found)) == sorted(map(str, [rows[1], rows[2], rows[4], rows[5]]))
