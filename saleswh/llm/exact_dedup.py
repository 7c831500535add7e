"""Exact duplicates by a tree-merge of sorted digest runs.

Each task turns its rows into a run: one entry per digest with the row to keep
and the number of rows. Runs are numbered by task, and a number is read as hex
digits. In round r the sixteen runs that differ in digit r only exchange
entries: each gets those whose digest has its digit there, and merges sixteen
sorted parts into one run, where an entry keeps the best of its rows. After the
last round an entry stands where its digest says, alone. No run ever outgrows
sixteen times a first one, and a text with very many copies is one entry per run from the
start. An entry is only merged with one of the same SHA-256, whatever its sort
digest. Each entry knows the first runs it came from, so verdicts go
back to the rows by run and digest, and copies of a text never meet in one task.
Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.llm.common import kept

BLANKS = " \t\n\x0b\x0c\r"
#: Bits of a run's number that one round replaces: sixteen runs exchange.
DIGIT_BITS = 4


def digest_rows(documents: DataFrame) -> DataFrame:
    """A stored row per document: ``doc_id, row, run, size, digest, sha``; the text is read here only."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.translate(text, BLANKS, "")
    return kept(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.char_length(text).cast("long").alias("size"),
            F.xxhash64(bare).alias("digest"),
            F.unhex(F.sha2(bare, 256)).alias("sha"),
            F.spark_partition_id().cast("long").alias("run"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


def _run_after(round_: int) -> Column:
    """The run an entry goes to: its own, one digit taken from the digest."""
    digit = ((1 << DIGIT_BITS) - 1) << (DIGIT_BITS * round_)
    return F.col("run").bitwiseAND(F.lit(~digit)).bitwiseOR(F.col("digest").bitwiseAND(F.lit(digit)))


def merged_runs(rows: DataFrame) -> DataFrame:
    """An entry per distinct text: ``digest, sha, n, best, runs``.

    ``best`` holds the row to keep: greatest size, then smallest doc_id (null
    last), then first row. ``runs`` are the first runs with the text, so at most
    one number per task that read the documents.
    """
    last = rows.agg(F.max("run").alias("last")).first()["last"] or 0
    rounds = max(1, -(-int(last).bit_length() // DIGIT_BITS))
    # Smaller ids are better, so they are compared by their complement; a missing one loses.
    best = F.struct("size", F.col("doc_id").isNotNull().alias("has_id"), F.bitwise_not("doc_id").alias("id"),
                    F.bitwise_not("row").alias("row"))
    # Map-side aggregation makes the first runs: what leaves a task is an entry per digest.
    entries = (
        rows.select(_run_after(0).alias("to"), "digest", "sha", best.alias("best"), "run")
        .groupBy(F.col("to").alias("run"), "digest", "sha")
        .agg(F.max("best").alias("best"), F.count("*").alias("n"), F.collect_set("run").alias("runs"))
    )
    for round_ in range(1, rounds):
        moved = entries.withColumn("run", _run_after(round_))
        sorted_parts = moved.repartition("run").sortWithinPartitions("run", "digest", "sha")
        entries = sorted_parts.groupBy("run", "digest", "sha").agg(
            F.max("best").alias("best"), F.sum("n").alias("n"), F.flatten(F.collect_list("runs")).alias("runs")
        )
    return entries.drop("run")


def exact_groups(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are without their blanks; a null text is an empty
    one, and empty and blank texts are equal. Of a group the row with the most
    code points stays, then that with the smallest doc_id (a null doc_id comes
    last), then the first one read: exactly one row of a group has ``kept``, also
    where rows share a doc_id or have none. Other columns are not read; no rows
    in, none out.
    """
    rows = digest_rows(documents)
    groups = merged_runs(rows).filter("n > 1").select(
        F.explode("runs").alias("run"),
        "digest",
        "sha",
        F.bitwise_not("best.id").alias("keep_id"),
        F.bitwise_not("best.row").alias("keep_row"),
        "n",
    )
    judged = rows.join(groups, ["run", "digest", "sha"], "left")
    alone = F.col("n").isNull()
    return judged.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


# first_value needs a full order; DuckDB puts null ids last.
GROUPS_SQL = r"""
WITH bare AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
    FROM documents
), judged AS (
    SELECT doc_id, bare, count(*) OVER (PARTITION BY bare) AS group_size,
           first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(text) DESC, doc_id) AS keep_id
    FROM bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM judged
"""
