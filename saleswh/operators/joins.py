"""Sums of facts grouped by columns of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Bytes that a row takes in a broadcast table beside its columns.
ROW_BYTES = 32


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate and the rows themselves are within its broadcast limit.

    Spark estimates by the size of files, where keys that follow one another take a
    byte or two: files of some megabytes may be a broadcast table of hundreds, which
    the driver builds. So rows that pass by the estimate are counted.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if not 0 <= estimate <= limit:
        return False
    return df.count() * (ROW_BYTES + df._jdf.schema().defaultSize()) <= limit


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that Spark must not broadcast, whatever it estimates."""
    return df.hint("merge")


def sums_of(facts: DataFrame, sums: Sequence[str]) -> list[Column]:
    return [_sum(facts, name) for name in sums]


def _sum(facts: DataFrame, name: str) -> Column:
    """The sum in the type that Spark gives a single sum of this column."""
    kind, total = facts.schema[name].dataType, F.sum(name)
    if isinstance(kind, T.DecimalType):
        total = total.cast(T.DecimalType(min(38, kind.precision + 10), kind.scale))
    return total.alias(name)


def sum_with_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    by: Sequence[str],
    sums: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Sums of ``facts``, grouped by columns of either side, after a join on ``key``.

    A dimension within the broadcast limit is joined first: the facts are not
    shuffled, and every task sends one row per group. A larger one is joined
    after the facts have been summed per key and own group columns: then a key
    with a huge share of the facts is reduced inside each task, and the join
    meets sums instead of facts. ``dimension`` has one row per key, so both
    ways give the same exact sums, and sums have one type whichever way is taken.
    """
    totals = sums_of(facts, sums)
    if not fits_broadcast(dimension):
        own = [name for name in by if name in facts.columns and name != key]
        facts, dimension = facts.groupBy(key, *own).agg(*totals), shuffled(dimension)
    return facts.join(dimension, key, how).groupBy(*by).agg(*totals)
