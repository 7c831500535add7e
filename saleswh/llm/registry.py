"""The operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saleswh.llm import (
    decontamination,
    exact_dedup,
    lm_scoring,
    near_duplicates,
    packing,
    periodic_runs,
    prefix_trie,
    quality,
    repeated_bytes,
    secrets,
    token_counts,
    token_files,
    url_filter,
)
from saleswh.llm.common import read_documents

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# The rules of the URL query.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(read_documents(spark, sf_dir))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated_pairs(read_documents(spark, sf_dir), benchmark)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read_documents(spark, sf_dir))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_groups(read_documents(spark, sf_dir))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), capacity=2048)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(
        read_documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), end_id=2, vocabulary=49408
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(read_documents(spark, sf_dir))


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes.without_repeats(read_documents(spark, sf_dir)).drop("kept_data")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(read_documents(spark, sf_dir))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Query] = {
    "op1_lm_score": op1_lm_score,
    "op2_decontamination": op2_decontamination,
    "op3_secrets": op3_secrets,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_url_filter": op6_url_filter,
    "op7_token_files": op7_token_files,
    "op8_quality_rules": op8_quality_rules,
    "op9_repeated_bytes": op9_repeated_bytes,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {"op12_exact_dedup": exact_dedup.GROUPS_SQL}
