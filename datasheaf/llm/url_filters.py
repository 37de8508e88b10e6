"""URL filters: host-suffix and path-prefix expressions against a rule list.

Each URL is expanded into the expressions a rule can have: the host's last k
labels, for each k that some rule's host has, with the path's first n
characters, for each n that some rule's path has. Expressions meet the rules in
an equi-join on the first four bytes of their SHA-256 digest; full digests are
then compared, and of the rules that fit the longest wins. All of it is
declarative; the join is broadcast by Catalyst only if the rule list is small
enough for the session's own threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from datasheaf.llm._common import staged

ALLOW, BLOCK = "allow", "block"

#: (verdict, host, path)
DEFAULT_RULES: tuple[tuple[str, str, str], ...] = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty where there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows; a rule given with both verdicts blocks."""
    rows = spark.createDataFrame([(v, h.lower(), p) for v, h, p in rules], "verdict string, host string, path string")
    return rows.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """Add host, path, rule and verdict to ``pages``.

    ``rules`` has verdict, host and path. A rule fits its host and all
    subdomains if the URL's path starts with the rule's; of the rules that fit
    the longest expression wins, then the longer host, then block. Where none
    fits, rule is null and verdict ``default``. A null URL or one without
    ``://`` has an empty host and path and fits no rule. Columns of ``pages``
    with the names of the results are replaced; rows are neither added nor lost.
    """
    depths = [r[0] for r in rules.select(F.size(F.split("host", r"\.")).alias("k")).distinct().collect()]
    lengths = [r[0] for r in rules.select(F.length("path").alias("n")).distinct().collect()]
    bare = pages.drop("host", "path", "rule", "verdict").withColumn("host", url_host(F.col(url_col))).withColumn("path", url_path(F.col(url_col)))
    if not depths:
        return bare.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))

    labels = F.size(F.split("host", r"\."))
    suffixes = F.array_compact(F.array(*[F.when(labels >= k, F.substring_index("host", ".", -k)) for k in sorted(depths)]))
    prefixes = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)]))
    expressions = (
        bare.select("host", "path")
        .distinct()
        .filter(F.col("host") != "")
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("expression", F.explode(F.transform(prefixes, lambda p: F.concat(F.col("suffix"), p))))
        .withColumn("digest", _digest(F.col("expression")))
        .withColumn("short", F.substring("digest", 1, 8))
    )
    listed = rules.select("verdict", F.col("host").alias("rule_host"), F.concat("host", "path").alias("rule")).withColumn("rule_digest", _digest(F.col("rule"))).withColumn("short", F.substring("rule_digest", 1, 8))
    rank = F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), "verdict", "rule")
    best = staged(
        expressions.join(listed, "short")
        # the digest confirms the expression; the host says where it is cut
        .filter((F.col("digest") == F.col("rule_digest")) & (F.col("suffix") == F.col("rule_host")))
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best")),
        "best-rules",
    )
    return (
        bare.join(best, ["host", "path"], "left")
        .withColumn("rule", F.col("best.rule"))
        .withColumn("verdict", F.coalesce(F.col("best.verdict"), F.lit(default)))
        .drop("best")
    )
