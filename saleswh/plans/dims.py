"""Customer and product dimensions: one current row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.operators.dedupe import last_row
from saleswh.operators.files import stored
from saleswh.operators.joins import shuffled
from saleswh.operators.merge import insert_if_absent, merge_rows
from saleswh.operators.numbering import dense_numbers
from saleswh.operators.tables import VersionedTable
from saleswh.sources import conform

#: Buckets of a dimension that is still to be written.
BUCKETS = 8


def customer_rows(source: DataFrame, name_candidates: Sequence[str] = conform.CUSTOMER_NAME) -> DataFrame:
    return last_row(conform.customers(source, name_candidates), ["customer_id"])


def product_rows(source: DataFrame) -> DataFrame:
    return last_row(conform.products(source), ["product_id"])


def upsert_dimension(table: VersionedTable, rows: DataFrame, key: str) -> None:
    """Overwrites attributes by key; surrogate keys and absent rows stay; rows without a key are left out.

    A dimension is stored in buckets by hash of the key. Rows that are stored as
    they are drop out first, and only buckets with a new or changed row are
    replaced; without any, nothing is written.
    """
    buckets = table.notes().get("buckets", BUCKETS)
    keyed = rows.filter(F.col(key).isNotNull()).withColumn(
        table.partition, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    )
    attributes = F.struct(*(name for name in rows.columns if name != key))
    known = table.read().select(key, table.surrogate, attributes.alias("_known"))
    changed = stored(
        keyed.join(known, key, "left").filter(~attributes.eqNullSafe(F.col("_known"))).select(*keyed.columns, table.surrogate)
    )
    touched = [row[0] for row in changed.select(table.partition).distinct().collect()]
    if not touched:
        return
    new = changed.filter(F.col(table.surrogate).isNull())
    numbers, highest = dense_numbers(new, key, table.surrogate, table.highest())
    # As many numbers as new rows: Spark would take them to be as small as the files of the source.
    updates = changed.drop(table.surrogate).join(shuffled(numbers), key, "left")
    current = table.read(stored=True).filter(F.col(table.partition).isin(touched))
    merged = merge_rows(current, updates, [key], kept=[table.surrogate])
    table.replace(merged.hint("rebalance", table.partition), touched, highest, {"buckets": buckets})


def add_missing(table: VersionedTable, rows: DataFrame, key: str) -> None:
    """Appends the rows whose key is new; does not write when there are none."""
    fresh = insert_if_absent(table.read(), rows, [key])
    if not table.folders() or not fresh.isEmpty():
        table.append(fresh)


def source_counts(**sources: DataFrame) -> DataFrame:
    """One row per source table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sources.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def product_categories(source: DataFrame) -> DataFrame:
    return conform.products(source).select("category").distinct()
