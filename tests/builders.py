"""Small hand-written tables for the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleswh import schema
from saleswh.plans.star import Star
from saleswh.sources import conform, generators, retail
from saleswh.sources.bundle import Sources


def orders(spark, *rows):
    """(order_id, customer_id, timestamp text, currency)"""
    df = spark.createDataFrame(list(rows), "order_id long, customer_id long, ts string, currency string")
    return df.select(
        "order_id", "customer_id", F.col("ts").cast("timestamp_ntz").alias("order_timestamp"), "currency"
    )


def items(spark, *rows):
    """(order_item_id, order_id, product_id, quantity, unit price)"""
    df = spark.createDataFrame(
        list(rows), "order_item_id long, order_id long, product_id long, quantity double, unit_price double"
    )
    return conform.order_items(df)


def rates(spark, *rows):
    """(date text, currency, rate)"""
    df = spark.createDataFrame(list(rows), "d string, currency string, r string")
    return df.select(
        F.col("d").cast("date").alias("fx_date"),
        "currency",
        F.col("r").cast(schema.RATE).alias("rate_to_usd"),
        F.lit("p").alias("source"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("fetched_at"),
    )


def products(spark, *rows):
    """(product_id, name, category)"""
    return spark.createDataFrame(list(rows), "product_id long, name string, category string")


def customers(spark, *rows):
    """(customer_id, full_name, country)"""
    return spark.createDataFrame(list(rows), "customer_id long, full_name string, country string")


FACT_DEFAULTS = {
    "order_item_id": 1,
    "order_id": 1,
    "product_id": 1,
    "customer_id": 1,
    "date_key": 20240101,
    "time_key": 0,
    "quantity": "1",
    "unit_price_orig": "10",
    "currency": "USD",
    "fx_rate_to_usd": "1",
    "line_amount_usd": "10",
}


def facts(spark, *rows):
    """Fact rows from dicts of the columns that matter; item ids count up."""
    full = [{**FACT_DEFAULTS, "order_item_id": n, "order_id": n, **row} for n, row in enumerate(rows, 1)]
    columns = list(FACT_DEFAULTS)
    types = {field.name: field.dataType for field in schema.FACT_SALES_ITEM.fields}
    texts = [tuple(None if row[c] is None else str(row[c]) for c in columns) for row in full]
    df = spark.createDataFrame(texts, ", ".join(f"{c} string" for c in columns))
    typed = df.select(*(F.col(c).cast(types[c]).alias(c) for c in columns))
    return typed.withColumn("unit_price_usd", F.col("unit_price_orig"))


def star(spark, fact, goods=None, people=None, fx=None):
    from datetime import date

    return Star(
        fact=fact,
        dim_product=goods if goods is not None else products(spark, (1, "Cup", "Home"), (2, "Pen", "Office")),
        dim_customer=people if people is not None else customers(spark, (1, "Ann Lee", "PT")),
        dim_date=generators.calendar(spark, F.lit(date(2024, 6, 1))),
        dim_time=generators.minutes(spark),
        dim_fx_rate=fx if fx is not None else rates(spark, ("2024-01-01", "EUR", "1.5")),
    )


def sources(spark, order_rows, item_rows, product_rows, customer_rows, quoted=None):
    """Sources in their own column names."""
    return Sources(
        customers=spark.createDataFrame(customer_rows, "id long, full_name string, email string, country string"),
        orders=orders(spark, *order_rows).withColumnRenamed("order_timestamp", "order_date"),
        order_items=spark.createDataFrame(
            item_rows, "id long, order_id long, product_id long, quantity int, unit_price decimal(10,2)"
        ),
        products=spark.createDataFrame(product_rows, "id long, name string, category string"),
        fx_snapshot=retail.snapshot(spark, "USD", quoted or {"EUR": 0.8, "GBP": 0.5}),
        fx_provider="p",
    )
