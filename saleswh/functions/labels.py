"""Labels for missing or untidy names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_unknown(text: Column) -> Column:
    """The text without outer blanks, or 'Unknown' where nothing is left."""
    return F.when(F.trim(text) != "", F.trim(text)).otherwise("Unknown")


def strip(text: Column) -> Column:
    """Removes any outer white space, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def title_case(text: Column) -> Column:
    """Capitalises after every non-letter: ``o'neil`` becomes ``O'Neil``."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def customer_label(name: Column, country: Column) -> Column:
    """'name — Country', with unknown names written in one way."""
    who = F.regexp_replace(
        strip(F.coalesce(name, F.lit("Unknown"))), r"(?iU)^\s*~?\s*unknown.*$", "Unknown Customer"
    )
    where = title_case(strip(F.coalesce(country, F.lit("Unknown"))))
    return F.concat(who, F.lit(" — "), where)
