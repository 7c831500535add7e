"""Declared types of the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(18, 8)

# The currencies that count as real ones in every report.
ISO_CURRENCIES = ["USD", "EUR", "GBP"]


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


DIM_DATE = _struct(
    date_key=T.IntegerType(),
    date=T.DateType(),
    year=T.ShortType(),
    quarter=T.ShortType(),
    month=T.ShortType(),
    day=T.ShortType(),
    day_of_week=T.ShortType(),
    is_weekend=T.BooleanType(),
)

DIM_TIME = _struct(time_key=T.ShortType(), hour=T.ShortType(), minute=T.ShortType())

DIM_CUSTOMER = _struct(
    customer_sk=T.LongType(),
    customer_id=T.LongType(),
    full_name=T.StringType(),
    email=T.StringType(),
    country=T.StringType(),
)

DIM_PRODUCT = _struct(
    product_sk=T.LongType(),
    product_id=T.LongType(),
    name=T.StringType(),
    category=T.StringType(),
    description=T.StringType(),
)

DIM_FX_RATE = _struct(
    fx_date=T.DateType(),
    currency=T.StringType(),
    rate_to_usd=RATE,
    source=T.StringType(),
    fetched_at=T.TimestampType(),
)

FACT_SALES_ITEM = _struct(
    sales_item_sk=T.LongType(),
    order_item_id=T.LongType(),
    order_id=T.LongType(),
    product_id=T.LongType(),
    customer_id=T.LongType(),
    date_key=T.IntegerType(),
    time_key=T.ShortType(),
    quantity=MONEY,
    unit_price_orig=MONEY,
    currency=T.StringType(),
    fx_rate_to_usd=RATE,
    unit_price_usd=MONEY,
    line_amount_usd=MONEY,
    created_at=T.TimestampType(),
)

# The stored fact carries its storage partition, the month of ``date_key``.
FACT_PARTITION = "sales_month"
FACT_STORED = T.StructType([*FACT_SALES_ITEM.fields, T.StructField(FACT_PARTITION, T.IntegerType())])

# Rows that a load refused, with the constraints they break.
FACT_REFUSED = T.StructType(
    [
        *(field for field in FACT_SALES_ITEM.fields if field.name not in ("sales_item_sk", "created_at")),
        T.StructField("broken", T.ArrayType(T.StringType())),
        T.StructField("refused_at", T.TimestampType()),
    ]
)

HOURLY_SALES = _struct(
    date=T.DateType(),
    hour=T.ShortType(),
    revenue_usd=T.DecimalType(28, 4),
    items_count=T.LongType(),
)

FX_SNAPSHOT = _struct(
    result=T.StringType(),
    base_code=T.StringType(),
    conversion_rates=T.MapType(T.StringType(), T.DoubleType()),
)
