"""The named report results.

Every sum over a dimension goes through ``sum_with_dimension``, which joins
first or sums first depending on the size of the dimension. Sorted results end
with the group key as a tie-break, so they are stable.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.functions import keys, labels
from saleswh.functions.money import is_fx_fallback, is_iso
from saleswh.operators.files import delete, stored, write_once
from saleswh.operators.joins import fits_broadcast, shuffled, sum_with_dimension, sums_of
from saleswh.operators.series import pivot_sum, running_total, trailing_mean
from saleswh.plans.star import DEFAULT_END, DEFAULT_START, Star
from saleswh.plans.views import sales_base
from saleswh.schema import FACT_PARTITION


# What reports read of a sale.
_REPORTED = ["order_id", "customer_id", "date_key", "time_key", "currency", "quantity", "line_amount_usd"]


def _largest(measure: str, *tie_break: str) -> list[Column]:
    return [F.desc_nulls_first(measure), *(F.asc_nulls_last(name) for name in tie_break)]


def _measures(sales: DataFrame) -> DataFrame:
    """The two summed columns under the names they are reported by."""
    return sales.withColumnsRenamed({"quantity": "units", "line_amount_usd": "revenue"})


def _iso_sales(star: Star, start: str, end: str) -> DataFrame:
    """Sales of the window in real currencies, of known and unknown products."""
    return _measures(keys.in_window(star.fact, start, end).filter(is_iso(F.col("currency"))))


def _product_names(star: Star) -> DataFrame:
    return star.dim_product.select(
        "product_id", F.col("category").alias("product_category"), F.col("name").alias("product_name")
    )


@contextmanager
def joined_once(star: Star, start: str, end: str) -> Iterator[Star]:
    """A star for several reports of one window, to be used within the block only.

    A catalogue too large to be broadcast would meet the sums of each report in a
    shuffle of its own. Here it meets the window's sales in real currencies once; what
    comes of it is written to the shared folder and takes the place of the facts.
    """
    names = _product_names(star)
    if fits_broadcast(names):
        yield star
        return
    sales = keys.in_window(star.fact, start, end).filter(is_iso(F.col("currency")))
    known = sales.join(shuffled(names), "product_id").select(*_REPORTED, *names.columns[1:])
    joined, path = write_once(known, "joined-sales")
    try:
        yield replace(star, fact=joined)
    finally:
        delete(star.fact.sparkSession, path)


def _is_joined(sales: DataFrame) -> bool:
    return "product_name" in sales.columns


def _by_product(sales: DataFrame, star: Star, *by: str) -> DataFrame:
    """Units and revenue of known products."""
    if _is_joined(sales):
        return sales.groupBy(*by).agg(*sums_of(sales, ["units", "revenue"]))
    return sum_with_dimension(sales, _product_names(star), "product_id", by, ["units", "revenue"])


# Products and categories


def top_products(
    star: Star,
    start: str = DEFAULT_START,
    end: str = DEFAULT_END,
    categories: Sequence[str] | None = None,
    limit: int = 20,
) -> DataFrame:
    """Products by revenue, of all categories or of those listed."""
    totals = _by_product(_iso_sales(star, start, end), star, "product_category", "product_name")
    if categories is not None:
        totals = totals.filter(F.col("product_category").isin(list(categories)))
    return totals.orderBy(*_largest("revenue", "product_category", "product_name")).limit(limit)


def category_performance(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """Units and revenue per category, highest revenue first."""
    totals = _by_product(_iso_sales(star, start, end), star, "product_category")
    return totals.orderBy(*_largest("revenue", "product_category"))


def revenue_by_category(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    return category_performance(star, start, end).select("product_category", "revenue", "units")


def revenue_by_product(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END, limit: int = 15) -> DataFrame:
    """Product names by revenue; products that share a name count as one."""
    totals = _by_product(_iso_sales(star, start, end), star, "product_name")
    ordered = totals.orderBy(*_largest("revenue", "product_name")).limit(limit)
    return ordered.select("product_name", "revenue", "units")


def top_products_all_currencies(star: Star, limit: int = 10) -> DataFrame:
    """Product names by revenue over all time and all currencies."""
    totals = _by_product(_measures(star.fact), star, "product_name")
    return (
        totals.withColumnRenamed("revenue", "revenue_usd")
        .orderBy(*_largest("revenue_usd", "product_name"))
        .limit(limit)
    )


# Time


def _hour_totals(star: Star, start: str, end: str) -> DataFrame:
    sales = _iso_sales(star, start, end).withColumn("hour_of_day", keys.hour_of_day())
    return _by_product(sales, star, "hour_of_day").select("hour_of_day", "revenue", "units")


def best_hours(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    return _hour_totals(star, start, end).orderBy(*_largest("revenue", "hour_of_day"))


def revenue_by_hour(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    return _hour_totals(star, start, end).orderBy("hour_of_day")


def _day_totals(star: Star, start: str, end: str) -> DataFrame:
    days = _by_product(_iso_sales(star, start, end), star, "date_key")
    return days.select(keys.key_to_date().alias("sales_date"), "revenue")


def daily_revenue(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    return _day_totals(star, start, end).orderBy("sales_date")


def daily_revenue_ma(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END, rows: int = 7) -> DataFrame:
    """Daily revenue with the mean of the last ``rows`` days that had sales."""
    average = trailing_mean("revenue", "sales_date", rows)
    return _day_totals(star, start, end).select(
        "sales_date", "revenue", average.alias(f"revenue_{rows}d_ma")
    ).orderBy("sales_date")


def daily_revenue_cumulative(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    total = running_total("revenue", "sales_date")
    return _day_totals(star, start, end).select(
        "sales_date", total.alias("cumulative_revenue")
    ).orderBy("sales_date")


def _weekday_hours(star: Star, start: str, end: str) -> DataFrame:
    """Summed per day and hour first; the weekday is worked out once per day."""
    sales = _iso_sales(star, start, end).withColumn("hour_of_day", keys.hour_of_day())
    weekday = keys.weekday_iso(keys.key_to_date())
    return (
        _by_product(sales, star, "date_key", "hour_of_day")
        .groupBy(weekday.alias("weekday_iso"), "hour_of_day")
        .agg(F.sum("revenue").alias("revenue"))
    )


def weekday_hour_revenue(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    return _weekday_hours(star, start, end).orderBy("weekday_iso", "hour_of_day")


def weekday_hour_matrix(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """Seven rows, Monday first, with the revenue of hours ``h0`` .. ``h23``."""
    totals = _weekday_hours(star, start, end).withColumn(
        "hour", F.concat(F.lit("h"), F.col("hour_of_day").cast("string"))
    )
    hours = [f"h{hour}" for hour in range(24)]
    matrix = pivot_sum(totals, "weekday_iso", "hour", "revenue", hours)
    weekdays = totals.sparkSession.range(1, 8).selectExpr("CAST(id AS INT) AS weekday_iso")
    return weekdays.join(matrix, "weekday_iso", "left").na.fill(0, hours).orderBy("weekday_iso")


def _month_categories(star: Star, start: str, end: str) -> DataFrame:
    sales = _iso_sales(star, start, end).withColumn("month_key", keys.month_of_key())
    month = F.expr("make_date(month_key DIV 100, month_key % 100, 1)")
    totals = _by_product(sales, star, "product_category", "month_key")
    return totals.select("product_category", month.alias("month"), "revenue")


def monthly_revenue_by_category(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    return _month_categories(star, start, end).orderBy(F.asc_nulls_last("product_category"), "month")


def monthly_matrix(
    star: Star, categories: Sequence[str], start: str = DEFAULT_START, end: str = DEFAULT_END
) -> DataFrame:
    """Revenue per month, one column for each category listed; months in which none of them sold are left out."""
    monthly = _month_categories(star, start, end).filter(F.col("product_category").isin(list(categories)))
    return pivot_sum(monthly, "month", "product_category", "revenue", list(categories)).orderBy("month")


def monthly_top_matrix(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END, top: int = 5) -> DataFrame:
    """Revenue per month, one column for each of the ``top`` largest categories.

    The category names become column names, so they have to be known before
    the matrix is planned. The monthly sums are checkpointed in between, so
    the sales are read once.
    """
    monthly = stored(_month_categories(star, start, end).filter("product_category IS NOT NULL"))
    leading = (
        monthly.groupBy("product_category")
        .agg(F.sum("revenue").alias("total"))
        .orderBy(*_largest("total", "product_category"))
        .limit(top)
    )
    names = sorted(row["product_category"] for row in leading.collect())
    kept = monthly.filter(F.col("product_category").isin(names))
    return pivot_sum(kept, "month", "product_category", "revenue", names).orderBy("month")


def monthly_top_rows(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END, top: int = 5) -> DataFrame:
    """The same matrix with one row per month and category."""
    matrix = monthly_top_matrix(star, start, end, top)
    names = [f"`{name}`" for name in matrix.columns if name != "month"]
    return matrix.unpivot(["month"], names, "product_category", "revenue")


def weekend_revenue(star: Star, quarters: Sequence[int] = (1, 2, 3, 4)) -> DataFrame:
    """Units and revenue on Saturdays and Sundays of the quarters listed, per year and quarter, in real currencies.

    The days are chosen in the calendar. It is joined by month as well as by day,
    so the months of other quarters are pruned from the facts when the query runs.
    """
    chosen = star.dim_date.filter(F.col("is_weekend") & F.col("quarter").isin(list(quarters)))
    days = chosen.select("date_key", keys.month_of_key().alias(FACT_PARTITION), "year", "quarter")
    sales = _measures(star.fact.filter(is_iso(F.col("currency"))))
    return (
        sales.join(days, [FACT_PARTITION, "date_key"])
        .groupBy("year", "quarter")
        .agg(F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
        .orderBy("year", "quarter")
    )


# Customers and countries. Countries are grouped as stored and labelled after.


def _by_customer(star: Star, start: str, end: str, *by: str) -> DataFrame:
    """Revenue of clean sales, by columns of the sale or the customer.

    Products only have to exist: a small list of their keys is broadcast, and a
    large one meets sales that have been summed per product and customer.
    """
    name = F.coalesce(labels.or_unknown(F.col("full_name")), F.lit("Unknown")).alias("named")
    people = star.dim_customer.select("customer_id", name, F.col("country").alias("raw_country"))
    sales = _iso_sales(star, start, end)
    if not _is_joined(sales):
        known = star.dim_product.select("product_id")
        if not fits_broadcast(known):
            own = [column for column in by if column in sales.columns]
            sales = sales.groupBy("product_id", "customer_id", *own).agg(F.sum("revenue").alias("revenue"))
            known = shuffled(known)
        sales = sales.join(known, "product_id", "left_semi")
    totals = sum_with_dimension(sales, people, "customer_id", by, ["revenue"], how="left")
    return totals.withColumn("revenue", F.col("revenue").cast("decimal(28,4)"))


def top_customers(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END, limit: int = 10) -> DataFrame:
    """Customers by revenue, with their number of orders."""
    per_order = _by_customer(star, start, end, "named", "raw_country", "order_id")
    totals = per_order.groupBy(
        F.coalesce("named", F.lit("Unknown")).alias("customer_name"), "raw_country"
    ).agg(F.countDistinct("order_id").alias("orders"), F.sum("revenue").alias("revenue"))
    country = labels.or_unknown(F.col("raw_country")).alias("country")
    return (
        totals.orderBy(*_largest("revenue", "customer_name", "raw_country"))
        .limit(limit)
        .select("customer_name", country, "orders", "revenue")
    )


def top_customer_labels(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END, limit: int = 10) -> DataFrame:
    label = labels.customer_label(F.col("customer_name"), F.col("country"))
    return top_customers(star, start, end, limit).select(label.alias("label"), "revenue")


def revenue_by_country(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    totals = _by_customer(star, start, end, "raw_country")
    return totals.orderBy(*_largest("revenue", "raw_country")).select(
        labels.or_unknown(F.col("raw_country")).alias("country"), "revenue"
    )


def avg_order_value_by_country(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """Mean order total per country label."""
    orders = _by_customer(star, start, end, "order_id", "raw_country")
    average = F.sum("revenue").cast("double") / F.count("revenue")
    return (
        orders.groupBy(labels.or_unknown(F.col("raw_country")).alias("country"))
        .agg(average.alias("avg_order_value"))
        .orderBy(*_largest("avg_order_value", "country"))
    )


# Currencies and rates


def non_iso_currency_counts(star: Star) -> DataFrame:
    wrong = sales_base(star.fact).filter("is_non_iso_currency")
    counts = wrong.groupBy(F.col("currency").alias("wrong_currency")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counts.orderBy(*_largest("row_count", "wrong_currency"))


def fx_coverage(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """Lines in the window, and how many of them have a rate or the fallback."""
    fallback = is_fx_fallback(F.col("currency"), F.col("fx_rate_to_usd"))
    counted = _iso_sales(star, start, end).select(
        "product_id",
        F.lit(1).cast("bigint").alias("lines_total"),
        fallback.cast("bigint").alias("lines_fx_fallback"),
    )
    names = ["lines_total", "lines_fx_fallback"]
    known = star.dim_product.select("product_id")
    counts = sum_with_dimension(counted, known, "product_id", [], names).na.fill(0)
    covered = F.greatest(F.col("lines_total") - F.col("lines_fx_fallback"), F.lit(0))
    return counts.withColumn("lines_with_rate", covered)


def fx_summary(star: Star) -> DataFrame:
    rates = star.fact.groupBy("currency").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.avg("fx_rate_to_usd"), 6).alias("avg_fx")
    )
    return rates.orderBy("currency")


def fx_latest(star: Star, limit: int = 20) -> DataFrame:
    columns = ["fx_date", "currency", "rate_to_usd", "source", "fetched_at"]
    return star.dim_fx_rate.select(columns).orderBy(F.desc("fx_date"), "currency").limit(limit)


def fact_spot_check(star: Star, limit: int = 10) -> DataFrame:
    """The first facts by item id with their rate and amounts."""
    columns = ["currency", "fx_rate_to_usd", "unit_price_orig", "unit_price_usd", "line_amount_usd"]
    return star.fact.select("order_item_id", *columns).orderBy("order_item_id").limit(limit)


def fx_reconciliation(star: Star, limit: int | None = 10) -> DataFrame:
    """Stored against recomputed USD price of converted facts; None lists all."""
    expected = (F.col("unit_price_orig") * F.col("fx_rate_to_usd")).cast("decimal(18,4)")
    rows = (
        star.fact.filter(F.col("currency").isin("EUR", "GBP"))
        .select(
            "order_item_id",
            "currency",
            "fx_rate_to_usd",
            "unit_price_orig",
            "unit_price_usd",
            expected.alias("expected_usd"),
        )
        .orderBy("order_item_id")
    )
    return rows if limit is None else rows.limit(limit)
