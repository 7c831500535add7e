"""Source tables with differing column names, brought to one shape.

Each function is a single projection, so only the columns named here are read
from the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.functions.keys import date_key
from saleswh.schema import MONEY
from saleswh.sources.columns import find_column, optional_text, required

# Accepted source names per column, most preferred first.
ORDER_ID = ["order_id", "id"]
ORDER_CUSTOMER = ["customer_id", "customer", "cust_id"]
ORDER_TIME = ["order_timestamp", "order_datetime", "created_at", "ordered_at", "order_date"]
ORDER_CURRENCY = ["currency", "currency_code"]
ITEM_ID = ["order_item_id", "id"]
ITEM_ORDER = ["order_id", "order"]
ITEM_PRODUCT = ["product_id", "product"]
ITEM_QUANTITY = ["quantity", "qty"]
ITEM_PRICE = ["unit_price", "price", "unitprice"]
CUSTOMER_ID = ["customer_id", "id"]
CUSTOMER_NAME = ["full_name"]
CUSTOMER_FIRST_NAME = ["first_name", "firstname"]
CUSTOMER_LAST_NAME = ["last_name", "lastname"]
CUSTOMER_EMAIL = ["email"]
CUSTOMER_COUNTRY = ["country", "country_code", "nation"]
PRODUCT_ID = ["product_id", "id"]
PRODUCT_NAME = ["name", "product_name"]
PRODUCT_CATEGORY = ["category", "product_category"]
PRODUCT_DESCRIPTION = ["description", "details"]


def read_table(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """Any Spark source: ``parquet``, ``csv``, ``json``, ``orc`` or ``jdbc``.

    For ``jdbc`` pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``, else one task reads the whole table.
    """
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def orders(df: DataFrame) -> DataFrame:
    return df.select(
        required(df, ORDER_ID).cast("bigint").alias("order_id"),
        required(df, ORDER_CUSTOMER).cast("bigint").alias("customer_id"),
        required(df, ORDER_TIME).alias("order_timestamp"),
        required(df, ORDER_CURRENCY).alias("currency"),
    )


def order_items(df: DataFrame) -> DataFrame:
    """Quantity and price that are no numbers raise an error when read."""
    return df.select(
        required(df, ITEM_ID).cast("bigint").alias("order_item_id"),
        required(df, ITEM_ORDER).cast("bigint").alias("order_id"),
        required(df, ITEM_PRODUCT).cast("bigint").alias("product_id"),
        required(df, ITEM_QUANTITY).cast(MONEY).alias("quantity"),
        required(df, ITEM_PRICE).cast(MONEY).alias("unit_price_orig"),
    )


def product_keys(df: DataFrame) -> DataFrame:
    return df.select(required(df, PRODUCT_ID).cast("bigint").alias("product_id"))


def customers(df: DataFrame, name_candidates: Sequence[str] = CUSTOMER_NAME) -> DataFrame:
    """``name_candidates`` names whole-name columns; first and last name come next."""
    whole = find_column(df.columns, name_candidates)
    parts = [
        df[name]
        for name in (
            find_column(df.columns, CUSTOMER_FIRST_NAME),
            find_column(df.columns, CUSTOMER_LAST_NAME),
        )
        if name
    ]
    if whole:
        full_name = df[whole]
    elif parts:
        full_name = F.concat_ws(" ", *parts)
    else:
        full_name = F.lit(None)
    return df.select(
        required(df, CUSTOMER_ID).cast("bigint").alias("customer_id"),
        full_name.cast("string").alias("full_name"),
        optional_text(df, CUSTOMER_EMAIL).alias("email"),
        optional_text(df, CUSTOMER_COUNTRY).alias("country"),
    )


def products(df: DataFrame) -> DataFrame:
    return df.select(
        required(df, PRODUCT_ID).cast("bigint").alias("product_id"),
        required(df, PRODUCT_NAME).cast("string").alias("name"),
        required(df, PRODUCT_CATEGORY).cast("string").alias("category"),
        optional_text(df, PRODUCT_DESCRIPTION).alias("description"),
    )


def order_date_range(orders_df: DataFrame) -> DataFrame:
    """One row with the first and last order day; both NULL without orders."""
    return orders_df.agg(
        F.to_date(F.min("order_timestamp")).alias("first_day"),
        F.to_date(F.max("order_timestamp")).alias("last_day"),
    )


def order_currencies(orders_df: DataFrame) -> DataFrame:
    """Every currency code to hold rates for: those ordered in, and the ISO three."""
    spark = orders_df.sparkSession
    found = orders_df.filter(F.col("currency").isNotNull()).select(
        F.substring(F.upper("currency"), 1, 3).alias("currency")
    )
    always = spark.sql("SELECT explode(array('USD', 'EUR', 'GBP')) AS currency")
    return found.distinct().union(always).distinct()


def fact_fx_rates(dim_fx_rate: DataFrame) -> DataFrame:
    """Rates keyed as the fact looks them up: date key and upper-cased code.

    Codes that differ only in case would double a sale, so one is kept; the
    code that sorts first wins.
    """
    chosen = F.min(F.struct("currency", "rate_to_usd"))
    return dim_fx_rate.groupBy(
        date_key(F.col("fx_date")).alias("date_key"), F.upper("currency").alias("code")
    ).agg(chosen.alias("kept")).select(
        "date_key", F.col("code").alias("currency"), F.col("kept.rate_to_usd").alias("rate_to_usd")
    )

