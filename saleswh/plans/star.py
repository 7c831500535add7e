"""The loaded warehouse as seen by reports and checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from saleswh.functions.keys import in_window
from saleswh.plans.views import clean_sales

# The window of reports that name none.
DEFAULT_START = "2024-01-01"
DEFAULT_END = "2024-12-31"


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    dim_date: DataFrame
    dim_time: DataFrame
    dim_fx_rate: DataFrame

    def sales(self, start: str, end: str) -> DataFrame:
        """Clean sales from ``start`` to ``end``; the window reaches the scan."""
        return clean_sales(in_window(self.fact, start, end), self.dim_product)
