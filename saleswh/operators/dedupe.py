"""One row per key, by aggregation.

Both keep a whole row with min or max over a struct. That combines within each
map task before the shuffle, so a key with very many copies sends at most one
row per task, and the result does not depend on the order rows arrive in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row per key by ``order``; all other columns break ties."""
    return _one_row(df, keys, order, F.min)


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row per key by ``order``; all other columns break ties."""
    return _one_row(df, keys, order, F.max)


def _one_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], pick: Callable[[Column], Column]
) -> DataFrame:
    ranked = [*order, *(name for name in df.columns if name not in keys and name not in order)]
    kept = df.groupBy(*keys).agg(pick(F.struct(*ranked)).alias("_kept"))
    return kept.select(*(F.col(name if name in keys else f"_kept.{name}") for name in df.columns))
