"""Daily rates to USD: one row per day and currency."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.functions.money import usd_rate
from saleswh.operators.files import stored
from saleswh.operators.merge import merge_rows
from saleswh.operators.tables import VersionedTable
from saleswh.schema import RATE
from saleswh.sources.conform import order_currencies, order_date_range
from saleswh.sources.fx_snapshot import quotes


def currency_rates(currencies: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The rate to USD of every currency, from one snapshot of any base."""
    base = snapshot.select("base_code").scalar()
    usd_units = snapshot.select(F.try_element_at("conversion_rates", F.lit("USD"))).scalar()
    quoted = quotes(snapshot).select("currency", "units_per_base")
    return currencies.join(quoted, "currency", "left").select(
        "currency",
        usd_rate(F.col("currency"), F.col("units_per_base"), base, usd_units).alias("rate_to_usd"),
    )


def fx_rate_rows(
    orders: DataFrame,
    snapshot: DataFrame,
    provider: str,
    fetched_at: datetime,
    run_date: date | None = None,
) -> DataFrame:
    """Rows for ``run_date`` alone, or for every day orders were placed between.

    Without a run date the first to the last order day is filled; with no orders
    there are no rows. The days are unfolded from a two-date array on each
    currency row.
    """
    if run_date:
        low = high = F.lit(run_date)
    else:
        days = order_date_range(orders)
        low, high = days.select("first_day").scalar(), days.select("last_day").scalar()
    rates = currency_rates(order_currencies(orders), snapshot)
    base = snapshot.select("base_code").scalar()
    bounded = rates.select(
        "currency",
        "rate_to_usd",
        F.format_string("%s (latest base=%s)", F.lit(provider), base).alias("source"),
        low.alias("low"),
        high.alias("high"),
    ).filter("low <= high")
    return bounded.select(
        F.explode(F.sequence("low", "high")).alias("fx_date"),
        "currency",
        "rate_to_usd",
        "source",
        _timestamp(fetched_at).alias("fetched_at"),
    )


def upsert_fx_rates(table: VersionedTable, rows: DataFrame) -> None:
    """Overwrites rates by day and currency.

    A rate that is stored with the same value and source stays as it is, with the
    moment it was first fetched. Only years with a new or another rate are
    rewritten; without any, nothing is.
    """
    keyed = rows.withColumn(table.partition, F.year("fx_date"))
    known = table.read().select("fx_date", "currency", F.struct("rate_to_usd", "source").alias("_known"))
    new = F.struct(F.col("rate_to_usd").cast(RATE).alias("rate_to_usd"), "source")
    changed = stored(
        keyed.join(known, ["fx_date", "currency"], "left").filter(~new.eqNullSafe(F.col("_known"))).select(*keyed.columns)
    )
    years = [row[0] for row in changed.select(table.partition).distinct().collect()]
    if not years:
        return
    current = table.read(stored=True).filter(F.col(table.partition).isin(years))
    merged = merge_rows(current, changed, ["fx_date", "currency"])
    table.replace(merged.hint("rebalance", table.partition), years)


def _timestamp(moment: datetime) -> Column:
    return F.lit(moment).cast("timestamp")
