"""Registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import chat_format, decontaminate, divergence, exact_dedup, html_extract, language_id, lexical_search, mixing, ngram_join, substring_dedup, token_count, toxicity, url_filter
from ledgerline.llm.oracle import ORACLE


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_read(spark, sf_dir, "pages"), url_filter.rules_table(spark, url_filter.RULES))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_language(_read(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return token_count.count_document_tokens(_read(spark, sf_dir, "documents"), model)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _, _ = mixing.mix_sources(_read(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(_read(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated"
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(_read(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


#: A conversation that consists of control strings, besides those given.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        vocabulary = chat_format.Vocabulary(f.read(), public_tokenizers.PATTERN)
    given = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_conversations(given.unionByName(more), vocabulary), vocabulary)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_read(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(lexical_search.build_index(_read(spark, sf_dir, "documents")), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_url_filter, op3_language_id, op4_token_counts, op5_source_mix, op6_ngram_join, op7_decontamination,
        op8_substring_dedup, op9_html_extraction, op10_toxicity, op11_chat_format, op12_source_divergence, op13_lexical_search,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
