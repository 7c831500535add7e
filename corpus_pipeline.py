"""Documents to packed training sequences: five stages, each stored and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saleswh.llm import decontamination, near_duplicates, packing, quality, secrets
from saleswh.llm.common import read_documents
from saleswh.llm.registry import tokenizer_file
from saleswh.operators.files import delete, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# Each stage keeps all columns of documents, whatever else they hold and however they are named. Repeated rows
# are rows of their own except in near_dedup; a null doc_id stays null; an empty table gives an empty one.


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules call good. Null, empty and blank texts have no words and go; long ones are read whole."""
    return quality.drop_low_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest doc_id (null last).

    Of repeated rows one stays. A text without words is alike with nothing and stays.
    """
    return near_duplicates.one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item by half or more. A text without words covers nothing and stays."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets masked; a null text stays null."""
    return secrets.redact_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens; a null or empty text is its end id."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

# Label models, signatures and token ids cannot be stated in SQL; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's result is a table in the shared folder until the next one is written.

    The last table stays, since the returned frame reads it: ``clear_scratch`` removes it.
    """
    docs, before = read_documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
