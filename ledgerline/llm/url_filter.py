"""URL filters: host-suffix and path-prefix expressions, joined to the rules on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import LOWER, UPPER, materialise

#: The rules of the registered query: action, host, path. Fixed values.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: Hex digits of the short prefix that the join runs on (32 bits).
PREFIX_DIGITS = 8
URL = r"://([^/?#]*)([^?#]*)"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without a ``://`` and for null."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.regexp_extract(url, URL, 2)


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as a table (action, host, path)."""
    return spark.createDataFrame(rules, "action string, host string, path string")


def _expression(host: Column, path: Column) -> Column:
    """What is hashed. A line feed cannot stand in a rule's host, so host and path stay apart."""
    return F.concat(host, F.lit("\n"), path)


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path starts with the rule's path. The longest rule (host and
    path together) wins; at equal length the longer host, then ``block``, then the smaller text. Without a rule the
    verdict is ``default``. Null urls and urls without ``://`` have empty host and path and fit no rule. Repeated
    rows are all reported; an empty table, or no rules, is no special case. Other columns are not read.

    Each distinct (host, path) is expanded once, into the host suffixes with as many labels as some rule's host and
    the path prefixes as long as some rule's path, so a long host or path costs no more than the rules need. The
    expressions meet the rules on the first 32 bits of their SHA-256, full digests are compared after. The verdicts
    are written to shared storage, so the join back to the rows is one between plain scans, where a url that makes up
    a third of the rows is split by adaptive execution. The driver sees only the rules' distinct label counts and
    path lengths, both bounded by the longest rule.
    """
    rules = rules.select("action", F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path")).where("rule_host <> ''")
    shapes = rules.agg(F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"), F.collect_set(F.char_length("rule_path")).alias("lengths")).first()
    digest = F.sha2(_expression(F.col("rule_host"), F.col("rule_path")), 256)
    listed = rules.distinct().select(
        F.substring(digest, 1, PREFIX_DIGITS).alias("short"),
        digest.alias("full"),
        F.struct(
            (F.char_length("rule_host") + F.char_length("rule_path")).alias("size"),
            F.char_length("rule_host").alias("host_size"),
            (F.col("action") == "block").alias("block"),
            F.concat("rule_host", "rule_path").alias("rule"),
            F.col("action").alias("verdict"),
        ).alias("found"),
    )
    host, path = split_url(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    labels = F.array(*[F.lit(int(n)) for n in sorted(shapes.labels)]).cast("array<int>")
    lengths = F.array(*[F.lit(int(n)) for n in sorted(shapes.lengths)]).cast("array<int>")
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.filter(labels, lambda n: n <= F.size(parts)), lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.char_length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = (
        rows.where("host <> ''")
        .select("host", "path")
        .distinct()
        .select("host", "path", F.explode(F.array_distinct(suffixes)).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .select("host", "path", F.sha2(_expression(F.col("suffix"), F.col("prefix")), 256).alias("digest"))
    )
    verdicts = (
        expressions.join(listed, (F.substring("digest", 1, PREFIX_DIGITS) == F.col("short")) & (F.col("digest") == F.col("full")))
        .groupBy(F.col("host").alias("of_host"), F.col("path").alias("of_path"))
        .agg(F.max_by("found", F.struct("found.size", "found.host_size", "found.block", "found.rule")).alias("found"))
        .select("of_host", "of_path", "found.rule", "found.verdict")
    )
    verdicts = materialise(verdicts, "op2-verdicts")
    return rows.join(verdicts.hint("merge"), (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path")), "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
