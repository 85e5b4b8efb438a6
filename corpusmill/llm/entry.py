"""The queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontaminate, exact_topk, filter_audit, html_extract, lexical_search, license_scan, near_dedup, piece_sampling, quality_rules, secret_scan, substring_dedup, token_files
from corpusmill.llm.common import scratch, table
from corpusmill.llm.token_counts import count_tokens


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.op2(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), seed=0)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token_files")
    token_files.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2, path)
    return token_files.read_ids(spark, path, with_ids=False)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op7(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.op10(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_html_extract, op2_secret_scan, op3_piece_sampling, op4_token_counts, op5_token_files, op6_near_dedup, op7_quality_rules, op8_substring_dedup, op9_decontaminate, op10_license_scan, op11_filter_audit, op12_exact_topk, op13_lexical_search)}


def oracle_sql() -> dict[str, str]:
    return {"op1_html_extract": html_extract.ORACLE, "op6_near_dedup": near_dedup.ORACLE, "op7_quality_rules": quality_rules.ORACLE, "op8_substring_dedup": substring_dedup.ORACLE, "op9_decontaminate": decontaminate.ORACLE, "op11_filter_audit": filter_audit.ORACLE, "op12_exact_topk": exact_topk.ORACLE, "op13_lexical_search": lexical_search.ORACLE}
