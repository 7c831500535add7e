"""Every named query as a function of session and table folder.

The report queries read a warehouse that the load writes once per session and
folder; the load operators have queries of their own. Money is exact decimal
throughout and becomes double only in the last projection.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.operators.files import replace_text, scratch_path, write_once
from saleswh.operators.merge import insert_if_absent, merge_rows
from saleswh.plans import dims, export, fact, fx, metrics, quality, sql, views
from saleswh.plans.pipeline import Warehouse
from saleswh.plans.star import Star
from saleswh.session import use_exact_decimals
from saleswh.sources import conform, generators, retail
from saleswh.sources.bundle import Sources
from saleswh.sources.fx_snapshot import read_snapshot

Query = Callable[[SparkSession, str], DataFrame]

RETAIL_AS_OF = date(2001, 8, 1)
EVENTS_AS_OF = date(2024, 2, 1)
RETAIL_YEARS_BACK = 7
FIRST_LOAD = datetime(2024, 3, 1)
SECOND_LOAD = datetime(2024, 3, 2)
FX_RUN_DATE = date(1999, 12, 31)
FILTERED_CATEGORIES = ["Brand#1", "Brand#2", "Brand#3"]
#: Days by which the second load moves some orders.
MOVED_DAYS = 40


_warehouses: dict[tuple[str, str, str], tuple[Warehouse, Star]] = {}
_readers: dict[tuple[str, str, str], Sources] = {}
_loading = Lock()


def _loaded(spark: SparkSession, folder: str, kind: str) -> tuple[Warehouse, Star]:
    """The warehouse of one kind, and its tables as the first load left them; loaded on first use by this session."""
    key = (spark.sparkContext.applicationId, folder, kind)
    loads = {"retail": load_retail, "events": load_events, "twice": load_twice, "spoiled": load_spoiled}
    with _loading:
        if key not in _warehouses:
            _warehouses[key] = loads[kind](spark, folder, scratch_path(spark, kind))
        return _warehouses[key]


def _sources(spark: SparkSession, folder: str, kind: str) -> Sources:
    """The source readers, so that a session looks up each file's schema once."""
    use_exact_decimals(spark)
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _readers:
        read = retail.retail_sources if kind == "retail" else retail.event_sources
        _readers[key] = read(spark, folder)
    return _readers[key]


def retail_star(spark: SparkSession, folder: str) -> Star:
    return _loaded(spark, folder, "retail")[1]


def event_star(spark: SparkSession, folder: str) -> Star:
    return _loaded(spark, folder, "events")[1]


def load_retail(spark: SparkSession, folder: str, root: str) -> tuple[Warehouse, Star]:
    warehouse = Warehouse(spark, root)
    warehouse.run(
        _sources(spark, folder, "retail"),
        as_of=RETAIL_AS_OF,
        years_back=RETAIL_YEARS_BACK,
        loaded_at=FIRST_LOAD,
    )
    return warehouse, warehouse.star()


def load_events(spark: SparkSession, folder: str, root: str) -> tuple[Warehouse, Star]:
    warehouse = Warehouse(spark, root)
    warehouse.run(
        _sources(spark, folder, "events"),
        as_of=EVENTS_AS_OF,
        run_date=retail.EVENTS_RUN_DATE,
        loaded_at=FIRST_LOAD,
    )
    return warehouse, warehouse.star()


def load_twice(spark: SparkSession, folder: str, root: str) -> tuple[Warehouse, Star]:
    """Four fifths of the orders, then a batch: the last fifth, and another one moved to later days.

    The batch brings the rates of one day from a snapshot with another base, and
    names for the customers of four segments.
    """
    whole = _sources(spark, folder, "retail")
    fifth = F.col("id") % 5
    warehouse = Warehouse(spark, root)
    warehouse.run(
        replace(whole, orders=whole.orders.filter(fifth != 0)),
        as_of=RETAIL_AS_OF,
        years_back=RETAIL_YEARS_BACK,
        loaded_at=FIRST_LOAD,
    )
    first = warehouse.star()
    later = F.when(fifth == 3, F.col("order_date") + F.expr(f"INTERVAL {MOVED_DAYS} DAY")).otherwise(F.col("order_date"))
    warehouse.run(
        replace(
            whole,
            orders=whole.orders.filter(fifth.isin(0, 3)).withColumn("order_date", later),
            customers=whole.customers.filter(F.col("segment") != "MACHINERY"),
            fx_snapshot=retail.snapshot(spark, "EUR", retail.EUR_QUOTES),
        ),
        as_of=RETAIL_AS_OF,
        years_back=RETAIL_YEARS_BACK,
        run_date=FX_RUN_DATE,
        name_candidates=["full_name", "name"],
        loaded_at=SECOND_LOAD,
    )
    return warehouse, first


def load_spoiled(spark: SparkSession, folder: str, root: str) -> tuple[Warehouse, Star]:
    """A load that is refused: customers and quantities missing, a currency too long, days before the calendar."""
    whole = _sources(spark, folder, "retail")
    order = F.col("id")
    orders = (
        whole.orders.withColumn("customer_id", F.when(order % 7 != 1, F.col("customer_id")))
        .withColumn("currency", F.when(order % 11 == 2, "EURO").otherwise(F.col("currency")))
        .withColumn(
            "order_date", F.when(order % 13 == 3, F.lit("1950-01-01").cast("timestamp_ntz")).otherwise(F.col("order_date"))
        )
    )
    items = whole.order_items.withColumn("quantity", F.when(order % 17 != 4, F.col("quantity")))
    spoiled = replace(whole, orders=orders, order_items=items)
    warehouse = Warehouse(spark, root)
    warehouse.create_schema(RETAIL_AS_OF, RETAIL_YEARS_BACK)
    warehouse.load_fx_rates(spoiled, FIRST_LOAD, FX_RUN_DATE)
    try:
        warehouse.load_fact(spoiled, FIRST_LOAD)
    except quality.QualityError:
        return warehouse, warehouse.star()
    raise AssertionError("a load with broken rows went through")


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that results compare across engines."""
    return df.select(
        *(
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        )
    )


def _on_retail(metric: Callable[..., DataFrame], **options: object) -> Query:
    return lambda spark, folder: _plain(
        metric(retail_star(spark, folder), *retail.RETAIL_WINDOW, **options)
    )


def _on_events(metric: Callable[..., DataFrame], **options: object) -> Query:
    return lambda spark, folder: _plain(
        metric(event_star(spark, folder), *retail.EVENTS_WINDOW, **options)
    )


def _on_star(metric: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: _plain(metric(retail_star(spark, folder)))


def _on_event_star(metric: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, folder: _plain(metric(event_star(spark, folder)))


def _on_sources(build: Callable[[SparkSession, Sources], DataFrame]) -> Query:
    return lambda spark, folder: _plain(build(spark, _sources(spark, folder, "retail")))


def _on_event_sources(build: Callable[[SparkSession, Sources], DataFrame]) -> Query:
    return lambda spark, folder: _plain(build(spark, _sources(spark, folder, "events")))


# Reports written in SQL on the views


def _report_sql(text: str, events: bool = False, **args: object) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        star = event_star(spark, folder) if events else retail_star(spark, folder)
        window = retail.EVENTS_WINDOW if events else retail.RETAIL_WINDOW
        return _plain(sql.run_report_sql(star, text, *window, **args))

    return run


# Load operators


def _dim_customer(spark: SparkSession, sources: Sources) -> DataFrame:
    return dims.customer_rows(sources.customers)


def _dim_customer_named(spark: SparkSession, sources: Sources) -> DataFrame:
    return dims.customer_rows(sources.customers, ["full_name", "name"])


def _dim_product(spark: SparkSession, sources: Sources) -> DataFrame:
    return dims.product_rows(sources.products)


def _dim_date(spark: SparkSession, sources: Sources) -> DataFrame:
    last_day = conform.order_date_range(conform.orders(sources.orders)).select("last_day").scalar()
    return generators.calendar(spark, last_day)


def _fx_rows(sources: Sources, run_date: date | None = None) -> DataFrame:
    return fx.fx_rate_rows(
        conform.orders(sources.orders),
        sources.fx_snapshot,
        sources.fx_provider,
        FIRST_LOAD,
        run_date,
    )


def _dim_fx_rate(spark: SparkSession, sources: Sources) -> DataFrame:
    return _fx_rows(sources).drop("fetched_at")


def _fx_single_date(spark: SparkSession, sources: Sources) -> DataFrame:
    return _fx_rows(sources, FX_RUN_DATE).drop("fetched_at")


def _fx_cross_rates(spark: SparkSession, sources: Sources) -> DataFrame:
    quoted_in_eur = retail.snapshot(spark, "EUR", retail.EUR_QUOTES)
    return fx.currency_rates(conform.order_currencies(conform.orders(sources.orders)), quoted_in_eur)


def _fx_snapshot_file(spark: SparkSession, sources: Sources) -> DataFrame:
    """Rates of the order currencies from a stored snapshot."""
    path = f"{scratch_path(spark, 'snapshot')}.json"
    rates = {"base": "EUR", "date": "2024-01-01", "rates": retail.EUR_QUOTES}
    replace_text(spark, path, json.dumps(rates))
    return fx.currency_rates(
        conform.order_currencies(conform.orders(sources.orders)), read_snapshot(spark, path)
    )


def _fx_upsert(spark: SparkSession, sources: Sources) -> DataFrame:
    """A full back-fill, then one day again from a snapshot with another base."""
    daily = fx.fx_rate_rows(
        conform.orders(sources.orders),
        retail.snapshot(spark, "EUR", retail.EUR_QUOTES),
        sources.fx_provider,
        SECOND_LOAD,
        FX_RUN_DATE,
    )
    return merge_rows(_fx_rows(sources), daily, ["fx_date", "currency"]).drop("fetched_at")


def _fact_columns(rows: DataFrame) -> DataFrame:
    return rows.drop("sales_item_sk", "created_at", "sales_month")


def _fact_upsert(spark: SparkSession, sources: Sources) -> DataFrame:
    """Finished and open orders at single-date rates, then open and pending ones anew.

    Open orders are in both batches: they take the new rate and keep the moment
    of the first load.
    """
    items = conform.order_items(sources.order_items)

    def batch(statuses: list[str], rates: DataFrame, moment: datetime) -> DataFrame:
        chosen = conform.orders(sources.orders.filter(F.col("status").isin(statuses)))
        stamp = F.lit(moment).cast("timestamp_ntz").alias("created_at")
        return fact.fact_rows(items, chosen, rates).select("*", stamp)

    merged = merge_rows(
        batch(["F", "O"], _fx_rows(sources, FX_RUN_DATE), FIRST_LOAD),
        batch(["O", "P"], _fx_rows(sources), SECOND_LOAD),
        ["order_item_id"],
        kept=["created_at"],
    )
    first = F.lit(FIRST_LOAD).cast("timestamp_ntz")
    return merged.select(
        "order_item_id",
        "currency",
        "fx_rate_to_usd",
        "line_amount_usd",
        F.when(F.col("created_at") == first, 1).otherwise(2).alias("created_by_load"),
    )


def _dim_upsert(spark: SparkSession, sources: Sources) -> DataFrame:
    """Unnamed customers of four segments, then named ones of four segments."""
    segment = F.col("segment")
    first = dims.customer_rows(sources.customers.filter(segment != "BUILDING"))
    second = dims.customer_rows(sources.customers.filter(segment != "MACHINERY"), ["full_name", "name"])
    return merge_rows(first, second, ["customer_id"])


def _insert_if_absent(spark: SparkSession, sources: Sources) -> DataFrame:
    """The minutes in which something was sold, completed to a whole day."""
    minute = conform.orders(sources.orders).select(
        F.date_format("order_timestamp", "H").cast("smallint").alias("hour"),
        F.date_format("order_timestamp", "m").cast("smallint").alias("minute"),
    )
    held = minute.distinct().selectExpr(
        "CAST(hour * 60 + minute AS SMALLINT) AS time_key", "hour", "minute", "TRUE AS had_sales"
    )
    rest = insert_if_absent(held, generators.minutes(spark), ["time_key"])
    return held.unionByName(rest.withColumn("had_sales", F.lit(False)))


def _orphan_items(spark: SparkSession, sources: Sources) -> DataFrame:
    items = conform.order_items(sources.order_items)
    return fact.orphan_items(items, conform.product_keys(sources.products)).select(
        "order_item_id", "order_id", "product_id", "quantity", "unit_price_orig"
    )


def _raw_fact(sources: Sources) -> DataFrame:
    """Facts with their copies still in, as they would be without the upsert."""
    sales = fact.order_item_sales(conform.order_items(sources.order_items), conform.orders(sources.orders))
    return fact.with_usd_amounts(sales, _fx_rows(sources))


def _dq_checks(star: Star) -> DataFrame:
    clean = views.clean_sales(star.fact, star.dim_product)
    return quality.dq_checks(star.fact, star.dim_date, star.dim_time, clean)


def _dq_checks_raw(spark: SparkSession, sources: Sources) -> DataFrame:
    """The checks on facts with copies and a calendar that is too short for them."""
    rows, _ = write_once(_raw_fact(sources), "raw-facts")
    days = generators.calendar(spark, F.lit(RETAIL_AS_OF))
    clean = views.clean_sales(rows, dims.product_rows(sources.products))
    return quality.dq_checks(rows, days, generators.minutes(spark), clean, non_iso_max_share=0.1)


def _dq_duplicates(spark: SparkSession, sources: Sources) -> DataFrame:
    return quality.duplicate_items(conform.order_items(sources.order_items))


def _source_counts(spark: SparkSession, sources: Sources) -> DataFrame:
    return dims.source_counts(
        customers=sources.customers,
        orders=sources.orders,
        order_items=sources.order_items,
        product_descriptions=sources.products,
    )


def _top_customers_named(spark: SparkSession, folder: str) -> DataFrame:
    star = retail_star(spark, folder)
    people = _dim_customer_named(spark, _sources(spark, folder, "retail"))
    named = Star(star.fact, star.dim_product, people, star.dim_date, star.dim_time, star.dim_fx_rate)
    return _plain(metrics.top_customers(named, *retail.RETAIL_WINDOW))


def _enriched(star: Star) -> DataFrame:
    return views.sales_enriched(views.sales_base(star.fact), star.dim_product)


def _hourly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_loaded(spark, folder, "events")[0].current_hourly_sales())


# Loads onto a filled warehouse


def _fact_second_load(spark: SparkSession, folder: str) -> DataFrame:
    first = F.lit(FIRST_LOAD).cast("timestamp")
    return _plain(
        _loaded(spark, folder, "twice")[0]
        .fact.read()
        .select(
            "order_item_id",
            "date_key",
            "currency",
            "fx_rate_to_usd",
            "line_amount_usd",
            F.when(F.col("created_at") == first, 1).otherwise(2).alias("created_by_load"),
        )
    )


def _hourly_second_load(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_loaded(spark, folder, "twice")[0].current_hourly_sales())


def _customer_second_load(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded(spark, folder, "twice")[0].dim_customer.read().drop("customer_sk")


def _fx_second_load(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_loaded(spark, folder, "twice")[0].dim_fx_rate.read().drop("fetched_at"))


def _surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Per table: rows, distinct numbers, the highest one, and rows that kept theirs in the second load."""
    warehouse, first = _loaded(spark, folder, "twice")
    tables = [
        ("fact_sales_item", warehouse.fact.read(), first.fact, "order_item_id", "sales_item_sk"),
        ("dim_customer", warehouse.dim_customer.read(), first.dim_customer, "customer_id", "customer_sk"),
        ("dim_product", warehouse.dim_product.read(), first.dim_product, "product_id", "product_sk"),
    ]
    found = None
    for name, now, before, key, number in tables:
        old = before.select(key, F.col(number).alias("old_number"))
        counts = now.join(old, key, "left").agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct(number).alias("numbers"),
            F.max(number).alias("highest"),
            F.count_if(F.col(number) == F.col("old_number")).alias("kept"),
        )
        found = counts if found is None else found.unionByName(counts)
    return found


def _load_refusals(spark: SparkSession, folder: str) -> DataFrame:
    return quality.refusals(_loaded(spark, folder, "spoiled")[0].refused.read())


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Three of the exported reports, read back from their files."""
    path = scratch_path(spark, "csv")
    export.export_reports(retail_star(spark, folder), path, *retail.RETAIL_WINDOW)
    labels = {
        "revenue_by_category": "product_category",
        "revenue_by_product_top15": "product_name",
        "revenue_by_country": "country",
    }
    found = None
    for name, label in labels.items():
        report = spark.read.option("header", True).csv(f"{path}/{name}").select(
            F.lit(name).alias("report"), F.col(label).alias("label"), F.col("revenue").cast("double").alias("revenue")
        )
        found = report if found is None else found.unionByName(report)
    return found


QUERIES: dict[str, Query] = {
    # Reports
    "top_products": _on_retail(metrics.top_products),
    "top_products_filtered": _on_retail(metrics.top_products, categories=FILTERED_CATEGORIES),
    "top_products_sql": _report_sql(sql.TOP_PRODUCTS, categories=None),
    "top_products_filtered_sql": _report_sql(sql.TOP_PRODUCTS, categories=FILTERED_CATEGORIES),
    "category_performance": _on_retail(metrics.category_performance),
    "category_performance_sql": _report_sql(sql.CATEGORY_PERFORMANCE),
    "revenue_by_category": _on_retail(metrics.revenue_by_category),
    "revenue_by_product": _on_retail(metrics.revenue_by_product),
    "top10_products_all_currencies": _on_star(metrics.top_products_all_currencies),
    "best_hours": _on_events(metrics.best_hours),
    "best_hours_sql": _report_sql(sql.BEST_HOURS, events=True),
    "revenue_by_hour": _on_events(metrics.revenue_by_hour),
    "daily_revenue": _on_events(metrics.daily_revenue),
    "daily_revenue_retail": _on_retail(metrics.daily_revenue),
    "daily_revenue_ma": _on_events(metrics.daily_revenue_ma),
    "daily_revenue_cumulative": _on_events(metrics.daily_revenue_cumulative),
    "weekday_hour_revenue": _on_events(metrics.weekday_hour_revenue),
    "weekday_hour_matrix": _on_events(metrics.weekday_hour_matrix),
    "monthly_revenue_by_category": _on_retail(metrics.monthly_revenue_by_category),
    "monthly_top5_matrix": _on_retail(metrics.monthly_top_matrix),
    "monthly_top5_rows": _on_retail(metrics.monthly_top_rows),
    "monthly_category_matrix": lambda spark, folder: _plain(
        metrics.monthly_matrix(retail_star(spark, folder), FILTERED_CATEGORIES, *retail.RETAIL_WINDOW)
    ),
    "weekend_revenue_by_quarter": _on_star(lambda star: metrics.weekend_revenue(star, quarters=[1, 4])),
    "top_customers": _on_retail(metrics.top_customers),
    "top_customers_named": _top_customers_named,
    "top_customer_labels": _on_events(metrics.top_customer_labels),
    "revenue_by_country": _on_retail(metrics.revenue_by_country),
    "avg_order_value_by_country": _on_retail(metrics.avg_order_value_by_country),
    "non_iso_currency_counts": _on_star(metrics.non_iso_currency_counts),
    "fx_coverage": _on_retail(metrics.fx_coverage),
    "fx_summary": _on_star(metrics.fx_summary),
    "fx_latest": lambda spark, folder: _plain(
        metrics.fx_latest(retail_star(spark, folder)).drop("fetched_at")
    ),
    "fact_spot_check": _on_star(metrics.fact_spot_check),
    "fx_reconciliation": _on_star(metrics.fx_reconciliation),
    "fx_reconciliation_all": _on_star(lambda star: metrics.fx_reconciliation(star, limit=None)),
    "hourly_sales": _hourly_sales,
    # Views
    "sales_base": _on_star(lambda star: _fact_columns(views.sales_base(star.fact))),
    "sales_enriched": _on_event_star(_enriched),
    "sales_clean": _on_event_star(lambda star: views.clean_sales(star.fact, star.dim_product)),
    "sales_valid": _on_star(lambda star: _fact_columns(views.sales_valid(star.fact))),
    # Loads
    "dim_date": _on_sources(_dim_date),
    "insert_if_absent": _on_event_sources(_insert_if_absent),
    "dim_customer": _on_sources(_dim_customer),
    "dim_customer_named": _on_sources(_dim_customer_named),
    "dim_product": _on_sources(_dim_product),
    "dim_fx_rate": _on_sources(_dim_fx_rate),
    "fx_single_date": _on_sources(_fx_single_date),
    "fx_cross_rates": _on_sources(_fx_cross_rates),
    "fx_snapshot_file": _on_sources(_fx_snapshot_file),
    "fx_upsert": _on_sources(_fx_upsert),
    "fact_sales_item": _on_star(lambda star: _fact_columns(star.fact)),
    "fact_upsert": _on_sources(_fact_upsert),
    "dim_upsert": _on_sources(_dim_upsert),
    "orphan_items": _on_event_sources(_orphan_items),
    "order_date_range": _on_sources(lambda spark, s: conform.order_date_range(conform.orders(s.orders))),
    "distinct_currencies": _on_sources(lambda spark, s: conform.order_currencies(conform.orders(s.orders))),
    "distinct_categories": _on_sources(lambda spark, s: dims.product_categories(s.products)),
    "source_counts": _on_sources(_source_counts),
    # Second loads
    "fact_second_load": _fact_second_load,
    "hourly_second_load": _hourly_second_load,
    "customer_second_load": _customer_second_load,
    "fx_second_load": _fx_second_load,
    "surrogate_keys": _surrogate_keys,
    "load_refusals": _load_refusals,
    "csv_round_trip": _csv_round_trip,
    # Quality
    "dq_verdict": _on_event_star(lambda star: quality.verdict_rows(_dq_checks(star))),
    "dq_verdict_raw": _on_sources(lambda spark, s: quality.verdict_rows(_dq_checks_raw(spark, s))),
    "dq_checks": _on_event_star(_dq_checks),
    "dq_checks_raw": _on_sources(_dq_checks_raw),
    "dq_duplicates": _on_sources(_dq_duplicates),
}
