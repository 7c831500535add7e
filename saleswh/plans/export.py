"""CSV export of the report datasets."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame

from saleswh.operators import files
from saleswh.plans import metrics
from saleswh.plans.star import DEFAULT_END, DEFAULT_START, Star


@dataclass(frozen=True)
class Report:
    name: str
    data: DataFrame
    write_empty: bool = True


def reports(star: Star, start: str = DEFAULT_START, end: str = DEFAULT_END) -> list[Report]:
    """The datasets that are exported, and whether they are when empty."""
    return [
        Report("revenue_by_category", metrics.revenue_by_category(star, start, end)),
        Report("revenue_by_product_top15", metrics.revenue_by_product(star, start, end)),
        Report("revenue_by_country", metrics.revenue_by_country(star, start, end)),
        Report("revenue_by_hour", metrics.revenue_by_hour(star, start, end)),
        Report("daily_revenue_with_ma", metrics.daily_revenue_ma(star, start, end), write_empty=False),
        Report("daily_revenue_cumulative", metrics.daily_revenue_cumulative(star, start, end), write_empty=False),
        Report("top_customers", metrics.top_customers(star, start, end)),
        Report("mom_by_category_top5_bars", metrics.monthly_top_matrix(star, start, end), write_empty=False),
        Report("avg_order_value_by_country", metrics.avg_order_value_by_country(star, start, end)),
    ]


def export_reports(star: Star, path: str, start: str = DEFAULT_START, end: str = DEFAULT_END) -> list[str]:
    """Publishes the datasets as headed CSV below ``path``, one folder each, and names those written.

    All of them are written aside first and take the place of ``path`` by a
    rename. A dataset that fails leaves the earlier output as it was, and folders
    of datasets that are no longer written go with it.
    """
    spark = star.fact.sparkSession
    target = path.rstrip("/")
    aside = f"{target}.next-{uuid.uuid4().hex}"
    written = []
    try:
        with metrics.joined_once(star, start, end) as shared:
            for report in reports(shared, start, end):
                if report.write_empty or not report.data.isEmpty():
                    report.data.write.option("header", True).csv(f"{aside}/{report.name}")
                    written.append(report.name)
        files.swap_in(spark, aside, target)
    except BaseException:
        files.delete(spark, aside)
        raise
    return written
