"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleswh.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z as a-z; other letters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; ``bytes`` knows exactly the blanks 09-0D and 20 and the letters A-Z."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _give_back() -> None:
    """Freed memory that Arrow and the C library keep for later goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim:
        trim(0)


def per_batch(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` under one name; a worker that waits for its next task gives unused memory back."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        _give_back()

    return df.mapInArrow(whole, schema)


#: Bits of a key table: 8 MB, whatever the corpus.
TABLE_BITS = 26


def key_table(keys: DataFrame) -> np.ndarray:
    """A table of fixed size with a bit set for each 64-bit ``key``: at most 2^20 numbers come to the driver.

    It tells rows that cannot meet any of the keys, before they are shuffled. The
    more keys there are, the more others it lets through; a join decides.
    """
    bit = F.col("key").bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    words = keys.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(key & 63 AS INT))")).alias("bits")
    )
    found = words.toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys.astype(np.uint64) & np.uint64((1 << TABLE_BITS) - 1)
    return (table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def rows_by_table(df: DataFrame, key: str, sent: Broadcast[np.ndarray], present: bool) -> DataFrame:
    """The rows of ``df`` whose ``key`` (a long, never null) has its bit set, or those whose has not."""
    at = df.columns.index(key)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = in_table(sent.value, batch.column(at).to_numpy()) == present
            if chosen.any():
                yield batch if chosen.all() else batch.filter(pa.array(chosen))

    return df.mapInArrow(choose, df.schema)


#: Rows that a task turns into Python objects at a time.
ROWS_AT_ONCE = 1000


def in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, at most ``ROWS_AT_ONCE`` at a time, copied: Arrow's if_else misreads sliced texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.take(pa.array(range(at, min(at + ROWS_AT_ONCE, batch.num_rows)), pa.int64()))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def record_batch(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names
    )
