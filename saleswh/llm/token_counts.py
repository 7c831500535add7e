"""Token counts: totals, quantiles and truncated totals for every context limit from one exact histogram.

Documents are counted by encoded length; the histogram has a row per distinct
length, however many documents share one. Sums from the shortest and from the
longest length on answer everything else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.common import kept, per_batch
from saleswh.llm.encoding import encoder

BLOCK = 4096


def length_histogram(documents: DataFrame, tokenizer: str, end_tokens: int = 1) -> DataFrame:
    """``n_tokens, n_docs``. Null text counts as empty: it has only the end tokens. No rows in, none out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = encoder(tokenizer).count(batch.column(0)) + end_tokens
            length, docs = np.unique(sizes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(length.astype(np.int64)), pa.array(docs.astype(np.int64))], names=["n_tokens", "n_docs"]
            )

    counted = per_batch(documents.select("text"), count, "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def running_totals(histogram: DataFrame) -> DataFrame:
    """Per length L, with L as the context limit.

    ``docs_up_to``/``tokens_up_to``: documents of at most L tokens and their
    tokens; ``docs_longer``: the rest; ``truncated_tokens``: what is left of all
    documents cut to L; ``total_*``: of everything; ``quantile``: share of the
    documents that have at most L tokens. Lengths are summed per block of 4096
    first, so no task gets them all.
    """
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs")
    )
    in_order = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_block = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = per_block.select(
        "block",
        F.coalesce(F.sum("d").over(in_order), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("t").over(in_order), F.lit(0)).alias("tokens_before"),
        F.sum("d").over(everything).alias("total_docs"),
        F.sum("t").over(everything).alias("total_tokens"),
    )
    within = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(before, "block").select(
        "n_tokens",
        "n_docs",
        (F.col("docs_before") + F.sum("n_docs").over(within)).alias("docs_up_to"),
        (F.col("tokens_before") + F.sum("tokens").over(within)).alias("tokens_up_to"),
        "total_docs",
        "total_tokens",
    )
    longer = F.col("total_docs") - F.col("docs_up_to")
    return summed.select(
        "*",
        longer.alias("docs_longer"),
        (F.col("tokens_up_to") + longer * F.col("n_tokens")).alias("truncated_tokens"),
        (F.col("docs_up_to") / F.col("total_docs")).alias("quantile"),
    )


def token_counts(documents: DataFrame, tokenizer: str, end_tokens: int = 1) -> DataFrame:
    """Histogram and totals in one frame: a row per distinct length.

    The histogram is stored, since its sums are read twice; the texts are encoded
    once. Null and empty texts have the end tokens only, very long ones are
    encoded in pieces, repeated rows count each, other columns are not read; no
    rows in, none out.
    """
    return running_totals(kept(length_histogram(documents, tokenizer, end_tokens)))


def at_limit(totals: DataFrame, limit: int) -> DataFrame:
    """Totals for any limit, also one that no document has: ``limit, kept_tokens, docs_longer, total_docs``."""
    short = F.col("n_tokens") <= limit
    return totals.agg(
        F.lit(limit).alias("limit"),
        F.coalesce(
            F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")), F.lit(0)
        ).alias("kept_tokens"),
        F.coalesce(F.sum(F.when(~short, F.col("n_docs"))), F.lit(0)).alias("docs_longer"),
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("total_docs"),
    )


def quantile_length(totals: DataFrame, share: float) -> DataFrame:
    """The shortest length that ``share`` of the documents do not exceed: ``n_tokens`` (null without documents)."""
    return totals.filter(F.col("docs_up_to") >= F.col("total_docs") * share).agg(F.min("n_tokens").alias("n_tokens"))
