"""Parquet folders bucketed by a key: joins on the key read them in place, without a shuffle.

Bucketed files are a matter of Spark's catalogue, so a table is registered under a name of its own while the
files are read or written, and dropped after that; the files stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@contextmanager
def opened(
    spark: SparkSession,
    columns: T.StructType,
    path: str,
    partition: str,
    key: str,
    buckets: int,
    folders: Mapping[object, str],
) -> Iterator[DataFrame]:
    """The rows of some partitions, each in the folder named; to be used within the block only."""
    name = f"bucketed_{uuid.uuid4().hex}"
    listed = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in columns.fields)
    spark.sql(
        f"CREATE TABLE {name} ({listed}) USING parquet PARTITIONED BY (`{partition}`) "
        f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    try:
        if folders:
            added = " ".join(f"PARTITION (`{partition}`={value}) LOCATION '{at}'" for value, at in folders.items())
            spark.sql(f"ALTER TABLE {name} ADD {added}")
        yield spark.table(name).select(*columns.fieldNames())
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write(df: DataFrame, path: str, partition: str, key: str, buckets: int, sort: str | None = None) -> None:
    """Writes a new folder, each bucket of a partition in as few files as tasks hold rows of it."""
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").partitionBy(partition).bucketBy(buckets, key)
    if sort:
        writer = writer.sortBy(sort)
    try:
        writer.option("path", path).option("compression", "zstd").saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
