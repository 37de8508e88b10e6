"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datasheaf.llm import bpe_transducer, exact_dedup, html_extraction, lm_scoring, packing, quality_rules, simhash_dedup, token_counts, toxicity, url_filters
from datasheaf.llm._common import vocabulary


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filters.rule_table(spark, url_filters.DEFAULT_RULES)
    return url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_prob")


def op6_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.encode_decode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_filters, op2_toxicity, op3_packing, op4_exact_dedup, op5_quality_rules, op6_bpe_coding, op7_lm_scoring, op8_html_extraction, op9_simhash_dedup, op10_token_counts)
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline

_URL_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filters.DEFAULT_RULES)

SQL: dict[str, str] = {
    "op1_url_filters": f"""
        WITH split AS (
            SELECT page_id, url,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        rules AS (SELECT * FROM (VALUES {_URL_RULES}) AS t(verdict, rule_host, rule_path)),
        fits AS (
            SELECT host, path, max(struct_pack(n := length(rule_host || rule_path), h := length(rule_host), v := verdict, r := rule_host || rule_path)) AS best
            FROM (SELECT DISTINCT host, path FROM split) s JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY host, path)
        SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict
        FROM split LEFT JOIN fits USING (host, path)""",
    "op4_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n""",
}
