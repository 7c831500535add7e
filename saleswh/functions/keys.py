"""Date and time keys, and the calendar attributes derived from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.schema import FACT_PARTITION


def date_key(ts: Column) -> Column:
    """yyyymmdd of a date or timestamp, as an int."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_key(ts: Column) -> Column:
    """Minute of the day, 0..1439."""
    return (F.hour(ts) * 60 + F.minute(ts)).cast("smallint")


def month_of_key(key: str = "date_key") -> Column:
    """yyyymm of a date key."""
    return F.expr(f"CAST({key} DIV 100 AS INT)")


def key_to_date(key: str = "date_key") -> Column:
    return F.expr(f"make_date(CAST({key} DIV 10000 AS INT), CAST({key} DIV 100 % 100 AS INT), {key} % 100)")


def hour_of_day(key: str = "time_key") -> Column:
    return F.expr(f"CAST({key} DIV 60 AS INT)")


def weekday_iso(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(day) + 1).cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def as_key(day: date | str) -> int:
    """The date key of a Python date or an ISO date string."""
    value = date.fromisoformat(day) if isinstance(day, str) else day
    return value.year * 10000 + value.month * 100 + value.day


def in_window(sales: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Rows from ``start`` to ``end``, both included.

    The bounds are integer literals on ``date_key``, so they reach the file
    scan; where the storage partition is present it is bounded too, so that
    months outside the window are never listed for reading.
    """
    low, high = as_key(start), as_key(end)
    window = F.col("date_key").between(low, high)
    if FACT_PARTITION in sales.columns:
        window = window & F.col(FACT_PARTITION).between(low // 100, high // 100)
    return sales.filter(window)
