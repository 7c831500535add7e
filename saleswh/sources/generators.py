"""Generated dimension rows: the calendar and the minutes of a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.functions.keys import date_key, weekday_iso


def calendar(spark: SparkSession, as_of: Column, years_back: int = 5, days_ahead: int = 365) -> DataFrame:
    """One row per day from ``years_back`` years before ``as_of`` on.

    ``as_of`` is a date column that needs no row of its own: a literal or a
    scalar subquery.
    """
    bounds = spark.range(1).select(
        F.add_months(as_of, -12 * years_back).alias("first_day"),
        F.date_add(as_of, days_ahead).alias("last_day"),
    )
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date"))
    day = F.col("date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.dayofmonth(day).cast("smallint").alias("day"),
        weekday_iso(day).cast("smallint").alias("day_of_week"),
        weekday_iso(day).isin(6, 7).alias("is_weekend"),
    )


def minutes(spark: SparkSession) -> DataFrame:
    """The 1,440 minutes of a day."""
    return spark.range(1440).selectExpr(
        "CAST(id AS SMALLINT) AS time_key",
        "CAST(id DIV 60 AS SMALLINT) AS hour",
        "CAST(id % 60 AS SMALLINT) AS minute",
    )
