"""Times the load and the headline queries; prints one JSON line.

Everything runs once to warm up; then the loads are timed once, into a fresh
folder, and each query three times for its median.
"""

from __future__ import annotations

import dataclasses
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saleswh.queries import registry  # noqa: E402
from saleswh.session import build_session  # noqa: E402
from saleswh.sources import retail  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "top_products",
    "top_products_filtered",
    "category_performance",
    "revenue_by_product",
    "top10_products_all_currencies",
    "best_hours",
    "daily_revenue_retail",
    "daily_revenue_ma",
    "daily_revenue_cumulative",
    "weekday_hour_matrix",
    "monthly_revenue_by_category",
    "monthly_top5_rows",
    "top_customers",
    "top_customers_named",
    "revenue_by_country",
    "avg_order_value_by_country",
    "non_iso_currency_counts",
    "fx_coverage",
    "fx_summary",
    "fx_reconciliation",
    "sales_valid",
    "dim_customer",
    "dim_fx_rate",
    "fact_upsert",
    "dq_checks",
    "dq_checks_raw",
    "dq_duplicates",
]


def second_loads(spark):
    """The same sources once more, and a batch of one order in a hundred with half of them moved to another day."""
    from pyspark.sql import functions as F

    whole = retail.retail_sources(spark, FOLDER)
    number = F.col("id")
    moved = F.when(number % 200 == 0, F.col("order_date") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("order_date"))
    batch = whole.orders.filter(number % 100 == 0).withColumn("order_date", moved)
    yield "second_load_unchanged", whole
    yield "second_load_batch", dataclasses.replace(whole, orders=batch)


def main() -> None:
    extra = {
        "spark__sql__shuffle__partitions": CPUS,
        "spark__ui__enabled": "false",
        "spark__driver__memory": "12g",
        "spark__ui__showConsoleProgress": "false",
    }
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        extra["spark__checkpoint__dir"] = tempfile.mkdtemp(prefix="saleswh-bench-")
    spark = build_session("bench", f"local[{CPUS}]", **extra)
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    registry.retail_star(spark, FOLDER), registry.event_star(spark, FOLDER)
    for kind, load in (("load_retail", registry.load_retail), ("load_events", registry.load_events)):
        start = time.perf_counter()
        warehouse, _ = load(spark, FOLDER, tempfile.mkdtemp(prefix="saleswh-bench-"))
        seconds[kind] = round(time.perf_counter() - start, 3)
        if kind == "load_retail":
            for again, sources in second_loads(spark):
                start = time.perf_counter()
                warehouse.run(
                    sources, registry.RETAIL_AS_OF, years_back=registry.RETAIL_YEARS_BACK, loaded_at=registry.SECOND_LOAD
                )
                seconds[again] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        times = []
        for run in range(RUNS + 1):
            start = time.perf_counter()
            registry.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            if run:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    scale = os.path.basename(os.path.normpath(FOLDER)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "warehouse_load_and_reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
