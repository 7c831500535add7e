"""Dense running numbers for rows in many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.operators.files import stored

_IN_TASK = (1 << 33) - 1


def dense_numbers(keys: DataFrame, key: str, surrogate: str, highest: int) -> tuple[DataFrame, int]:
    """``key`` and its number: ``highest + 1`` onwards without gaps, in order of the key; and the last number.

    ``keys`` holds each key once. Two passes: the keys are dealt out by range and
    counted per task, then every task begins where the ones before it end. The
    numbers depend on the keys alone, so a repeated load gives the same ones.
    Through the driver goes one count per task.
    """
    ordered = keys.select(key).repartitionByRange(key).sortWithinPartitions(key)
    placed = stored(
        ordered.select(
            key,
            F.spark_partition_id().alias("_task"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK)).alias("_place"),
        )
    )
    counts = sorted((row["_task"], row["count"]) for row in placed.groupBy("_task").count().collect())
    first, begins = highest + 1, []
    for task, count in counts:
        begins.append((task, first))
        first += count
    if not begins:
        return keys.select(key, F.lit(None).cast("bigint").alias(surrogate)), highest
    # Looked up in the projection: a join by task would deal the keys to one task per number.
    starts = F.create_map(*(F.lit(value) for task, start in begins for value in (task, start)))
    number = F.element_at(starts, F.col("_task")) + F.col("_place")
    return placed.select(key, number.cast("bigint").alias(surrogate)), first - 1
