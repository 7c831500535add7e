"""Currency normalising, rate conversion and exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from saleswh.schema import ISO_CURRENCIES, MONEY, RATE


def normal_currency(currency: Column) -> Column:
    """Upper-cased code, USD where there is none. Blanks are left alone."""
    return F.upper(F.coalesce(currency, F.lit("USD")))


def rate_or_fallback(rate: Column) -> Column:
    """A missing rate counts as 1, whatever the currency."""
    return F.coalesce(rate, F.lit(1).cast(RATE)).cast(RATE)


def unit_price_usd(price: Column, rate: Column) -> Column:
    return (price.cast(MONEY) * rate.cast(RATE)).cast(MONEY)


def line_amount_usd(quantity: Column, price: Column, rate: Column) -> Column:
    """Rounded once, half up, from the exact product of the unrounded inputs.

    The product has 16 decimals, which Spark keeps if decimal operations may not
    lose precision (``session.use_exact_decimals``). An amount that does not
    fit its column raises in the cast.
    """
    return (quantity.cast(MONEY) * price.cast(MONEY) * rate.cast(RATE)).cast(MONEY)


def usd_rate(code: Column, units: Column, base: Column, usd_units: Column) -> Column:
    """USD per one unit of ``code``.

    ``units`` is how many of ``code`` one ``base`` buys, ``usd_units`` how many
    USD. USD itself is 1; a missing or zero quote on either side gives 1.
    """
    usd_per_base = F.when(base == "USD", F.lit(1.0)).otherwise(F.nullif(usd_units, F.lit(0.0)))
    rate = F.when(code == "USD", F.lit(1.0)).otherwise(
        F.coalesce(usd_per_base / F.nullif(units, F.lit(0.0)), F.lit(1.0))
    )
    return rate.cast(RATE)


def is_iso(currency: Column) -> Column:
    return currency.isin(ISO_CURRENCIES)


def is_fx_fallback(currency: Column, rate: Column) -> Column:
    """A rate of exactly 1 on anything but USD, be it genuine or filled in."""
    return (rate == F.lit(1)) & (currency != "USD")
