"""Report SQL with bound parameters, for users who write SQL on the views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from saleswh.functions.keys import as_key
from saleswh.plans import views
from saleswh.plans.star import DEFAULT_END, DEFAULT_START, Star


def run_report_sql(
    star: Star, text: str, start: str = DEFAULT_START, end: str = DEFAULT_END, **args: object
) -> DataFrame:
    """Runs ``text`` on one warehouse, with ``:start_key`` and ``:end_key`` bound to the window.

    Views in braces, as ``{sales_clean}``, are those of ``star`` and of nothing
    else: no name is registered, so reports on several warehouses can run side by
    side. Bound values are literals to the planner: the window is pushed to the
    scan and no join with a parameter row is needed. Further named arguments,
    arrays included, are bound by their own names.
    """
    frames = {name: view for name, view in views.sales_views(star.fact, star.dim_product).items() if f"{{{name}}}" in text}
    bound = {"start_key": as_key(start), "end_key": as_key(end), **args}
    return star.fact.sparkSession.sql(text, args=bound, **frames)


TOP_PRODUCTS = """
    SELECT product_category, product_name, SUM(quantity) AS units, SUM(line_amount_usd) AS revenue
    FROM {sales_clean}
    WHERE date_key BETWEEN :start_key AND :end_key
      AND (:categories IS NULL OR array_contains(CAST(:categories AS ARRAY<STRING>), product_category))
    GROUP BY product_category, product_name
    ORDER BY revenue DESC, product_category, product_name
    LIMIT 20
"""

CATEGORY_PERFORMANCE = """
    SELECT product_category, SUM(quantity) AS units, SUM(line_amount_usd) AS revenue
    FROM {sales_clean}
    WHERE date_key BETWEEN :start_key AND :end_key
    GROUP BY product_category
    ORDER BY revenue DESC, product_category
"""

BEST_HOURS = """
    SELECT CAST(time_key DIV 60 AS INT) AS hour_of_day,
           SUM(line_amount_usd) AS revenue, SUM(quantity) AS units
    FROM {sales_clean}
    WHERE date_key BETWEEN :start_key AND :end_key
    GROUP BY hour_of_day
    ORDER BY revenue DESC, hour_of_day
"""
