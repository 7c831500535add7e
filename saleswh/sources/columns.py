"""Choosing source columns by candidate names at plan time."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_column(columns: Iterable[str], candidates: Sequence[str]) -> str:
    """The first candidate that exists; the order of the candidates decides."""
    found = find_column(columns, candidates)
    if found is None:
        raise ValueError(f"none of the columns {list(candidates)} exists")
    return found


def find_column(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    present = set(columns)
    return next((name for name in candidates if name in present), None)


def required(df: DataFrame, candidates: Sequence[str]) -> Column:
    return df[resolve_column(df.columns, candidates)]


def optional_text(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The column as text, or a NULL text column where no candidate exists."""
    name = find_column(df.columns, candidates)
    return (F.lit(None) if name is None else df[name]).cast("string")
