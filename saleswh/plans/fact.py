"""The sales fact: one row per order item, with amounts in USD."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.functions import keys, money
from saleswh.operators.dedupe import first_row
from saleswh.operators.files import stored, write_once
from saleswh.operators.key_index import KeyIndex
from saleswh.operators.merge import merge_rows
from saleswh.operators.numbering import dense_numbers
from saleswh.operators.tables import VersionedTable
from saleswh.schema import FACT_PARTITION, FACT_SALES_ITEM
from saleswh.sources.conform import fact_fx_rates

KEY = "order_item_id"
#: Items for each bucket of a fact that is still to be written; a task joins and sorts one bucket at a time.
BUCKET_ROWS = 1_500_000
#: With fewer buckets than this, tasks would be too few: such a fact is stored by month alone.
LEAST_BUCKETS = 4


def order_item_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with their order, keyed by day and minute.

    Items without an order drop out. The currency is the order's. An item's
    product need not be known: products add no column here, so they are not
    joined, and ``orphan_items`` reports the unknown ones.
    """
    placed = F.col("order_timestamp")
    return items.join(orders, "order_id").select(
        "order_item_id",
        "order_id",
        "product_id",
        "customer_id",
        keys.date_key(placed).alias("date_key"),
        keys.time_key(placed).alias("time_key"),
        "quantity",
        "unit_price_orig",
        money.normal_currency(F.col("currency")).alias("currency"),
    )


def with_usd_amounts(sales: DataFrame, dim_fx_rate: DataFrame) -> DataFrame:
    """Adds the rate of the order's day, or 1 where there is none, and USD amounts.

    Rates are small (days x currencies), so Spark broadcasts them while they
    stay under its size limit. Beyond it the join is by day and currency with
    the adaptive skew split on the sales side.
    """
    rate = money.rate_or_fallback(F.col("rate_to_usd"))
    quantity, price, fx = F.col("quantity"), F.col("unit_price_orig"), F.col("fx_rate_to_usd")
    rated = sales.join(fact_fx_rates(dim_fx_rate), ["date_key", "currency"], "left")
    return rated.select(*sales.columns, rate.alias("fx_rate_to_usd")).select(
        "*",
        money.unit_price_usd(price, fx).alias("unit_price_usd"),
        money.line_amount_usd(quantity, price, fx).alias("line_amount_usd"),
    )


def fact_rows(items: DataFrame, orders: DataFrame, dim_fx_rate: DataFrame) -> DataFrame:
    """Fact rows, one per order item: the first copy in column order is kept.

    The copies are removed before the rates are looked up, since the rate
    follows from columns the copies are chosen by.
    """
    unique = first_row(order_item_sales(items, orders), ["order_item_id"])
    return with_usd_amounts(unique, dim_fx_rate)


def orphan_items(items: DataFrame, product_keys: DataFrame) -> DataFrame:
    """Items whose product is not in the catalogue.

    The catalogue's keys are written once, which tells Spark how few they are. Else it
    takes them to be as large as what they were drawn from, and deals all items by
    product, to no more tasks than there are products.
    """
    known, _ = write_once(product_keys.distinct(), "product-keys")
    return items.join(known, "product_id", "left_anti")


def buckets_for(table: VersionedTable, items: DataFrame) -> int:
    """Buckets by order item that a load works in: those of the stored facts, else as many as the items fill.

    Only a first load counts its items, since Spark's estimate is no use for sources that are no files.
    """
    stored_in = table.buckets()
    if stored_in:
        return stored_in
    filled = items.count() // BUCKET_ROWS
    return filled if filled >= LEAST_BUCKETS else 1


def upsert_fact(table: VersionedTable, rows: DataFrame, loaded_at: datetime, buckets: int = 1) -> list[int]:
    """Overwrites facts by order item, and returns the days in which something changed.

    ``rows`` is read several times, so pass a written table. It is compared with
    the index of the stored facts, not with the facts: rows that are stored as
    they are drop out there. Months that gain, change or lose a row are merged
    and rewritten. The new facts and the new index become valid together. A load
    that changes nothing writes nothing.

    With more than one of ``buckets``, ``rows`` is read bucket by bucket, as are the
    index and the stored facts, so that the facts are joined and rewritten without
    a shuffle; only changed keys and new numbers are shuffled.
    """
    apart = buckets > 1
    index = KeyIndex(table.spark, f"{table.path}/key_index", KEY, **({"buckets": buckets} if apart else {}))
    state = table.notes().get("index")
    if state is None and table.folders():
        state = index.write(_entries(table.read()), None)
    updates = rows.withColumn(FACT_PARTITION, keys.month_of_key()).withColumn(
        "created_at", F.lit(loaded_at).cast("timestamp")
    )
    changes = _changes(index, state, _entries(updates))
    days = _changed_days(changes)
    if not days:
        return []
    months = sorted({day // 100 for day in days})
    new = changes.filter("before_day IS NULL")
    numbers, highest = dense_numbers(new, KEY, "sales_item_sk", table.highest())
    # A first load changes everything it brings.
    changed = updates if state is None else updates.join(changes.select(KEY), KEY, "left_semi")
    numbered = changed.join(numbers, KEY, "left")
    # Sorted files let date filters skip row groups.
    with table.opened(months) as current:
        merged = merge_rows(current, numbered, [KEY], kept=["sales_item_sk", "created_at"])
        spread = merged if apart else _by_month(merged).sortWithinPartitions(FACT_PARTITION, "date_key")
        notes = {**table.notes(), "index": _next_index(index, state, changes, apart)}
        if apart:
            notes["buckets"] = buckets
        table.replace(spread, months, highest, notes, sort="date_key")
    return days


def _entries(rows: DataFrame) -> DataFrame:
    """Key, day and a hash of all columns that a load sets."""
    compared = [name for name in FACT_SALES_ITEM.fieldNames() if name not in (KEY, "sales_item_sk", "created_at")]
    return rows.select(KEY, F.col("date_key").alias("stored_day"), F.xxhash64(*compared).alias("stored_print"))


def _changes(index: KeyIndex, state: dict | None, entries: DataFrame) -> DataFrame:
    """Entries that are new or differ from the index, with the day they were stored under (``before_day``)."""
    if state is None:
        return entries.withColumn("before_day", F.lit(None).cast("int"))
    new = entries.withColumnsRenamed({"stored_day": "day", "stored_print": "print"})
    with index.opened(state, index.slabs_of(entries, state)) as known:
        compared = new.join(known, KEY, "left").filter(~F.col("print").eqNullSafe(F.col("stored_print")))
        return stored(
            compared.select(
                KEY,
                F.col("day").alias("stored_day"),
                F.col("print").alias("stored_print"),
                F.col("stored_day").alias("before_day"),
            )
        )


def _changed_days(changes: DataFrame) -> list[int]:
    """Days that gain, change or lose a row: at most the days of the calendar."""
    days = changes.select(F.explode(F.array("stored_day", "before_day")).alias("day"))
    return sorted(row["day"] for row in days.filter("day IS NOT NULL").distinct().collect())


def _next_index(index: KeyIndex, state: dict | None, changes: DataFrame, apart: bool) -> dict:
    """``apart``: a first load's changes lie in their buckets."""
    if state is None:
        return index.write(changes, None, placed=apart)
    with index.opened(state, index.slabs_of(changes, state)) as known:
        # The join leaves every entry in the task of its bucket.
        merged = merge_rows(known, changes.drop("before_day"), [KEY])
        return index.write(merged, state, placed=apart)


def hourly_sales(fact: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Revenue and item count per day and hour, over all currencies, with the day's month.

    Summed per day and minute first, so the two dimensions meet at most one
    row per minute instead of every sale.
    """
    per_minute = fact.groupBy("date_key", "time_key").agg(
        F.sum("line_amount_usd").alias("revenue_usd"), F.count(F.lit(1)).alias("items_count")
    )
    return (
        per_minute.join(dim_date.select("date_key", "date"), "date_key")
        .join(dim_time.select("time_key", "hour"), "time_key")
        .groupBy("date", "hour", keys.month_of_key().alias(FACT_PARTITION))
        .agg(
            F.sum("revenue_usd").cast("decimal(28,4)").alias("revenue_usd"),
            F.sum("items_count").alias("items_count"),
        )
    )


def refresh_hourly(
    table: VersionedTable,
    fact: VersionedTable,
    dim_date: DataFrame,
    dim_time: DataFrame,
    changed: tuple[int, list[int]] | None = None,
) -> None:
    """Brings the hourly table up to date with the fact.

    ``changed`` holds the fact's change number before a load and the days the
    load touched. If the hourly table stood at that number, only these days are
    summed anew, and only their months are read and rewritten; in all other cases
    (no ``changed``, or an earlier refresh failed) everything is. The table notes
    the change number it stands at.
    """
    now = fact.change()
    notes = {"fact_change": now}
    before, days = changed or (None, [])
    at = table.notes().get("fact_change")
    if changed and at == now:
        return
    if before is None or at != before:
        table.replace(_by_month(hourly_sales(fact.read(), dim_date, dim_time)), notes=notes)
        return
    months = sorted({day // 100 for day in days})
    touched = table.spark.createDataFrame([(day,) for day in days], "date_key int")
    in_months = F.col(FACT_PARTITION).isin(months)
    again = fact.read().filter(in_months).join(touched, "date_key", "left_semi")
    rest = table.read(stored=True).filter(in_months)
    untouched = rest.join(touched, keys.date_key(F.col("date")) == touched["date_key"], "left_anti")
    table.replace(_by_month(untouched.unionByName(hourly_sales(again, dim_date, dim_time))), months, notes=notes)


def hourly_is_current(table: VersionedTable, fact: VersionedTable) -> bool:
    """Whether the hourly table stands for the facts as they are now."""
    return table.notes().get("fact_change") == fact.change()


def _by_month(rows: DataFrame) -> DataFrame:
    """Months in few files each, and in several tasks where one would be too large."""
    return rows.hint("rebalance", FACT_PARTITION)
