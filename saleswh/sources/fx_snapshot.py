"""Exchange-rate snapshots stored as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswh.schema import FX_SNAPSHOT

# Field names of the other published shape.
OTHER_SHAPE = T.StructType(
    [T.StructField("base", T.StringType()), T.StructField("rates", T.MapType(T.StringType(), T.DoubleType()))]
)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """One snapshot: ``result``, ``base_code`` and a map of code to units per base.

    Also taken is the shape with ``base``, ``date`` and ``rates``, which reports
    no result.
    """
    both = T.StructType([*FX_SNAPSHOT.fields, *OTHER_SHAPE.fields])
    found = spark.read.schema(both).option("multiLine", True).json(path)
    other = F.col("conversion_rates").isNull() & F.col("rates").isNotNull()
    return checked_snapshot(
        found.select(
            F.when(other & F.col("result").isNull(), "success").otherwise(F.col("result")).alias("result"),
            F.coalesce("base_code", "base").alias("base_code"),
            F.coalesce("conversion_rates", "rates").alias("conversion_rates"),
        )
    )


def checked_snapshot(snapshot: DataFrame) -> DataFrame:
    """The snapshot, unless its provider reported anything but success."""
    refused = snapshot.filter(~F.col("result").eqNullSafe("success")).limit(1).count()
    if refused:
        raise ValueError("the exchange-rate snapshot does not report success")
    return snapshot.select(
        F.upper(F.coalesce(F.nullif(F.trim("base_code"), F.lit("")), F.lit("USD"))).alias("base_code"),
        F.coalesce("conversion_rates", F.expr("CAST(map() AS MAP<STRING, DOUBLE>)")).alias(
            "conversion_rates"
        ),
    )


def quotes(snapshot: DataFrame) -> DataFrame:
    """One row per quoted code: base, code, and units of the code per one base."""
    return snapshot.select(
        "base_code", F.explode("conversion_rates").alias("currency", "units_per_base")
    )
