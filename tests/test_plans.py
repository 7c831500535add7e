"""What the plans of the hot paths look like."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleswh.plans import fact, metrics
from saleswh.plans.pipeline import Warehouse
from tests import builders as b
from tests.test_pipeline import AS_OF, CUSTOMERS, PRODUCTS

YEAR = ("2024-01-01", "2024-02-15")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    orders = [(n, 1 + n % 2, f"2024-0{1 + n % 5}-07 10:00:00", "EUR") for n in range(50)]
    items = [(n, n, 1 + n % 2, 1, Decimal("2.00")) for n in range(50)]
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("wh")))
    warehouse.run(b.sources(spark, orders, items, PRODUCTS, CUSTOMERS), AS_OF)
    return warehouse.star()


REPORTS = [
    metrics.top_products,
    metrics.category_performance,
    metrics.revenue_by_product,
    metrics.revenue_by_hour,
    metrics.daily_revenue_ma,
    metrics.weekday_hour_matrix,
    metrics.monthly_revenue_by_category,
    metrics.top_customers,
    metrics.revenue_by_country,
    metrics.avg_order_value_by_country,
    metrics.fx_coverage,
]


@pytest.mark.parametrize("report", REPORTS, ids=lambda report: report.__name__)
def test_reports_prune_and_stay_in_the_jvm(star, report):
    plan = _plan(report(star, *YEAR))
    assert "GreaterThanOrEqual(date_key,20240101)" in plan and "LessThanOrEqual(date_key,20240215)" in plan
    assert "(sales_month" in plan and "PartitionFilters: []" not in _fact_scan(plan)
    assert "In(currency, [EUR,GBP,USD])" in plan or "In(currency, [USD,EUR,GBP])" in plan
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def _fact_scan(plan):
    return next(line for line in plan.splitlines() if "FileScan" in line and "sales_month" in line)


def test_only_needed_columns_are_read(star):
    scan = _fact_scan(_plan(metrics.top_products(star, *YEAR)))
    columns = re.search(r"FileScan parquet \[(.*?)\]", scan).group(1)
    names = {column.split("#")[0] for column in columns.split(",")}
    assert names == {"product_id", "date_key", "quantity", "currency", "line_amount_usd", "sales_month", "version"}


def test_top_lists_do_not_sort_everything(star):
    for report in (metrics.top_products, metrics.revenue_by_product, metrics.top_customers):
        assert "TakeOrderedAndProject" in _plan(report(star, *YEAR))


@pytest.mark.parametrize("report", REPORTS, ids=lambda report: report.__name__)
def test_large_dimensions_meet_sums_and_give_the_same(spark, star, report):
    """Without broadcasts the facts are summed before any shuffle."""
    small = sorted(report(star, *YEAR).collect(), key=repr)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = report(star, *YEAR)
        plan = _plan(large)
        assert "SortMergeJoin" in plan
        shuffled = plan[plan.index("Exchange hashpartitioning(product_id") :]
        assert "partial_sum" in shuffled.split("FileScan")[0]
        assert sorted(large.collect(), key=repr) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_dimensions_leave_the_facts_in_place(star):
    """The facts reach their first shuffle as sums per group."""
    for report in REPORTS:
        plan = _plan(report(star, *YEAR))
        above_scan = plan[: plan.index(_fact_scan(plan))]
        assert "partial_sum" in above_scan[above_scan.rindex(" Exchange ") :]


def test_hot_order_is_split_in_the_item_join(spark):
    """One order with a third of all items does not end up in one task."""
    changed = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        number = F.col("id")
        items = spark.range(0, 300000, 1, 8).select(
            number.alias("order_item_id"),
            F.when(number % 3 == 0, 7).otherwise(number % 1000).alias("order_id"),
            (number % 50).alias("product_id"),
            F.lit(1).cast("decimal(18,4)").alias("quantity"),
            F.lit(2).cast("decimal(18,4)").alias("unit_price_orig"),
        )
        orders = spark.range(1000).select(
            number.alias("order_id"),
            number.alias("customer_id"),
            F.expr("timestamp_ntz '2024-01-01 00:00:00'").alias("order_timestamp"),
            F.lit("EUR").alias("currency"),
        )
        found = fact.fact_rows(items, orders, b.rates(spark, ("2024-01-01", "EUR", "1.5")))
        amounts = found.select("order_item_id", "line_amount_usd")
        assert len(amounts.collect()) == 300000
        assert "skew=true" in _plan(amounts)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_calendar_filters_prune_months_at_run_time(star):
    """A filter on the calendar alone keeps the facts of other quarters from being read."""
    found = metrics.weekend_revenue(star, quarters=[1])
    scan = _fact_scan(_plan(found))
    assert "dynamicpruning" in scan and "sales_month" in scan.split("PartitionFilters:")[1].split("dynamicpruning")[0]
    everything = {(row["year"], row["quarter"]): row["units"] for row in metrics.weekend_revenue(star).collect()}
    assert {(row["year"], row["quarter"]): row["units"] for row in found.collect()} == {
        key: units for key, units in everything.items() if key[1] == 1
    }


def test_items_are_not_dealt_by_product_to_find_orphans(spark):
    """A few products drawn from a large source: items stay where they are, however many have one product."""
    number = F.col("id")
    items = spark.range(0, 90000, 1, 6).select(number.alias("order_item_id"), (number % 3).alias("product_id"))
    nameless = spark.range(1).select(F.lit(-1).cast("long").alias("order_item_id"), F.lit(None).cast("long").alias("product_id"))
    source = spark.range(0, 4_000_000, 1, 4).select(F.when(number % 2 == 0, 0).otherwise(2).cast("long").alias("product_id"))
    found = fact.orphan_items(items.union(nameless), source)
    plan = _plan(found)
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert sorted(row[0] for row in found.select("order_item_id").collect()) == [-1, *range(1, 90000, 3)]
