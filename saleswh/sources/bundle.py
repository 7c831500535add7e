"""What one load reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Sources:
    """The source tables as they come, and one checked rate snapshot."""

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    fx_snapshot: DataFrame
    fx_provider: str
