"""Layered sales views.

``sales_clean`` serves the reports: known products and ISO currencies.
``sales_valid`` guards the load: ISO currencies and sane numbers, without
product columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.functions.money import is_fx_fallback, is_iso
from saleswh.schema import FACT_SALES_ITEM

# Report columns in order, as the enriched view lists them.
REPORT_COLUMNS = [
    "order_item_id",
    "order_id",
    "product_id",
    "customer_id",
    "date_key",
    "time_key",
    "quantity",
    "unit_price_orig",
    "currency",
    "fx_rate_to_usd",
    "unit_price_usd",
    "line_amount_usd",
    "is_non_iso_currency",
    "is_fx_fallback",
]


def fact_columns(fact: DataFrame) -> DataFrame:
    """The fact without its storage partition."""
    return fact.select(*(name for name in FACT_SALES_ITEM.fieldNames() if name in fact.columns))


def sales_base(fact: DataFrame) -> DataFrame:
    """Every fact with its two currency flags."""
    return fact_columns(fact).select(
        "*",
        (~is_iso(F.col("currency"))).alias("is_non_iso_currency"),
        is_fx_fallback(F.col("currency"), F.col("fx_rate_to_usd")).alias("is_fx_fallback"),
    )


def sales_enriched(base: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Facts of known products, with category and name."""
    attributes = dim_product.select(
        "product_id", F.col("category").alias("product_category"), F.col("name").alias("product_name")
    )
    return base.select(*REPORT_COLUMNS).join(attributes, "product_id").select(
        *REPORT_COLUMNS, "product_category", "product_name"
    )


def sales_clean(enriched: DataFrame) -> DataFrame:
    return enriched.filter(~F.col("is_non_iso_currency"))


def clean_sales(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """The three report layers on top of each other."""
    return sales_clean(sales_enriched(sales_base(fact), dim_product))


def sales_valid(fact: DataFrame) -> DataFrame:
    """Facts fit for use by the load's own rules; NULLs fail every one of them."""
    currency = F.upper(F.coalesce("currency", F.lit("USD")))
    return (
        fact_columns(fact)
        .withColumn("is_non_iso_currency", ~is_iso(currency))
        .filter(
            is_iso(currency)
            & (F.col("fx_rate_to_usd") > 0)
            & (F.col("quantity") >= 0)
            & (F.col("unit_price_orig") >= 0)
        )
    )


def sales_views(fact: DataFrame, dim_product: DataFrame) -> dict[str, DataFrame]:
    """The four views by name."""
    base = sales_base(fact)
    enriched = sales_enriched(base, dim_product)
    return {
        "sales_base": base,
        "sales_enriched": enriched,
        "sales_clean": sales_clean(enriched),
        "sales_valid": sales_valid(fact),
    }


def register_views(fact: DataFrame, dim_product: DataFrame) -> None:
    """(Re)creates the four views under their names in this session, for SQL users."""
    for name, view in sales_views(fact, dim_product).items():
        view.createOrReplaceTempView(name)
