"""Keyed upserts as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], kept: Sequence[str] = ()
) -> DataFrame:
    """``target`` after inserting or overwriting the rows of ``updates``.

    Both sides hold one row per key. Columns in ``kept`` stay as they are on
    rows that exist already; ``updates`` may leave them out, then new rows have
    NULL there. One full outer join, so each side is shuffled once.
    """
    marked = updates.withColumn("_update", F.lit(True)).alias("u")
    columns = []
    for name in target.columns:
        old, new = F.col(f"t.{name}"), F.col(f"u.{name}")
        if name in keys:
            columns.append(F.col(name))
        elif name in kept:
            columns.append((F.coalesce(old, new) if name in updates.columns else old).alias(name))
        else:
            columns.append(F.when(F.col("u._update"), new).otherwise(old).alias(name))
    return target.alias("t").join(marked, list(keys), "full_outer").select(*columns)


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``rows`` whose key ``target`` does not hold yet."""
    return rows.join(target.select(*keys), list(keys), "left_anti")
