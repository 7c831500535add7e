"""Windows over a series with one row per day.

The windows have no partition key, so one task sees the whole series. That is
safe only because the callers aggregate to one row per calendar day first: a
century is 36,525 rows, whatever the number of sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trailing_mean(value: str, order: str, rows: int) -> Column:
    """Mean of the current and the ``rows - 1`` previous rows that exist."""
    window = Window.orderBy(order).rowsBetween(-(rows - 1), Window.currentRow)
    return F.sum(value).over(window).cast("double") / F.count(value).over(window)


def running_total(value: str, order: str) -> Column:
    window = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(value).over(window)


def pivot_sum(df: DataFrame, index: str, column: str, value: str, wanted: list) -> DataFrame:
    """A matrix of sums with one column per wanted value and 0 where nothing is."""
    matrix = df.groupBy(index).pivot(column, wanted).agg(F.sum(value))
    return matrix.na.fill(0, [name for name in matrix.columns if name != index])
