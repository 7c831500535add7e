"""The retail and event tables brought into the shape of the sales sources.

Neither set holds currencies, and order times of the retail set are midnight,
so currencies are derived from another column and results by hour use events.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.sources.bundle import Sources
from saleswh.sources.fx_snapshot import checked_snapshot

PROVIDER = "rates.example"

# Units per one USD and per one EUR. No quote for ABC; the zero
# quote in the second one counts as missing.
USD_QUOTES = {"USD": 1.0, "EUR": 0.8606, "GBP": 0.7445}
EUR_QUOTES = {"EUR": 1.0, "USD": 1.162, "GBP": 0.865, "ABC": 0.0}

# The events are loaded with the rates of one day; sales of other days take the fallback rate.
EVENTS_RUN_DATE = date(2024, 1, 11)

# Windows the reports run over.
RETAIL_WINDOW = ("1996-01-01", "2000-12-31")
EVENTS_WINDOW = ("2024-01-01", "2024-12-31")


def snapshot(spark: SparkSession, base: str, units: dict[str, float]) -> DataFrame:
    pairs = ", ".join(f"'{code}', {number}D" for code, number in units.items())
    return checked_snapshot(
        spark.sql(f"SELECT 'success' AS result, '{base}' AS base_code, map({pairs}) AS conversion_rates")
    )


def retail_sources(spark: SparkSession, folder: str) -> Sources:
    """customer, nation, orders, lineitem and part as sales sources."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    priority = F.col("o_orderpriority")
    currency = (
        F.when(priority == "1-URGENT", "USD")
        .when(priority == "2-HIGH", "EUR")
        .when(priority == "3-MEDIUM", "GBP")
        .when(priority == "4-NOT SPECIFIED", "ABC")
    )
    nations = read("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return Sources(
        customers=read("customer")
        .join(nations, "c_nationkey", "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("country"),
        ),
        orders=read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("total_amount"),
            currency.alias("currency"),
            F.col("o_orderstatus").alias("status"),
        ),
        order_items=read("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price"),
        ),
        products=read("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("category"),
            F.col("p_type").alias("description"),
        ),
        fx_snapshot=snapshot(spark, "USD", USD_QUOTES),
        fx_provider=PROVIDER,
    )


def event_sources(spark: SparkSession, folder: str) -> Sources:
    """Each event as an order of one item; its type is the product.

    The catalogue holds every type but ``error``, so error events are sales of
    an unknown product.
    """
    events = spark.read.parquet(f"{folder}/events.parquet")
    product = F.expr(
        "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 "
        "WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 ELSE 0 END"
    )
    user = F.col("user_id") % 5
    currency = (
        F.when(user == 0, "USD").when(user == 1, "eur").when(user == 2, "GBP").when(user == 3, "ABC")
    )
    people = spark.read.parquet(f"{folder}/customer.parquet")
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    return Sources(
        customers=people.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("full_name"),
            F.col("n_name").alias("nation"),
        ),
        orders=events.select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("customer"),
            F.col("ts").alias("created_at"),
            currency.alias("currency_code"),
        ),
        order_items=events.select(
            F.col("event_id").alias("order_item_id"),
            F.col("event_id").alias("order"),
            product.alias("product"),
            F.lit(1).alias("qty"),
            F.col("value").alias("price"),
        ),
        products=events.filter("event_type <> 'error'")
        .select(
            product.alias("product_id"),
            F.col("event_type").alias("product_name"),
            F.col("event_type").alias("product_category"),
        )
        .distinct(),
        fx_snapshot=snapshot(spark, "USD", USD_QUOTES),
        fx_provider=PROVIDER,
    )
